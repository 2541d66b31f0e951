"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatplan.llm import (
    bpe, common, compression, context_mixing, decontaminate, jaccard, lexical, perplexity, pieces, revisits, token_counts, toxicity, url_rules, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: An id that the vocabulary leaves free.
END_OF_DOCUMENT = 50_256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules, table(spark, sf_dir, "labels"), url_rules.Settings(learn_from_rules=True))


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), common.fold("doc_id", 10) == 0
    trained = context_mixing.fit(docs.filter(~held))
    return context_mixing.score(docs, trained).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(trained.n).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte"
    )


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.assess(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), tokenizer()))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression.fit(docs, table(spark, sf_dir, "labels"), common.fold("doc_id", 5) != 0)
    scored = compression.score(docs, model)
    return scored.select(
        "doc_id", (common.fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "measure"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = common.written(token_counts.flat_blocks(table(spark, sf_dir, "documents"), tokenizer(), END_OF_DOCUMENT), "flat-tokens")
    return token_counts.named(token_counts.scan(blocks, END_OF_DOCUMENT), blocks)


def crawl(pages: DataFrame) -> DataFrame:
    """A crawl log made of ``pages``: each page is fetched in full once and asked again later, when the server says 304.

    Every seventh server forgets its ETags, every eleventh answers for another version.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    base = pages.select("page_id", "url", digest.alias("digest"), F.pmod(F.col("page_id") * 7919, F.lit(50_000)).alias("gap"))
    at = F.lit(1_700_000_000) + F.col("page_id") * 60
    tag = F.when(F.col("page_id") % 7 != 0, F.concat(F.lit('"'), "digest", F.lit('"')))
    full = base.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.timestamp_seconds(at).alias("at"), F.lit("response").alias("kind"), "digest",
        F.create_map(
            F.lit("content-type"), F.lit("text/html"), F.lit("date"), at.cast("string"), F.lit("etag"), tag,
            F.lit("last-modified"), (at - F.col("gap")).cast("string"), F.lit("server"), F.lit("origin"),
        ).alias("headers"),
    )
    later = at + 1 + F.col("gap") * 60
    other = F.when(F.col("page_id") % 11 == 0, F.lit('"other"')).otherwise(F.concat(F.lit('W/"'), "digest", F.lit('"')))
    asked = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", F.timestamp_seconds(later).alias("at"), F.lit("revisit").alias("kind"), "digest",
        F.create_map(
            F.lit("date"), later.cast("string"), F.lit("etag"), F.when(F.col("page_id") % 7 != 0, other),
            F.lit("last-modified"), (at - F.col("gap")).cast("string"), F.lit("expires"), (later + 3600).cast("string"),
            F.lit("content-length"), F.lit("0"), F.lit("server"), F.lit("edge"),
        ).alias("headers"),
    )
    return full.unionByName(asked)


def op9_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(crawl(table(spark, sf_dir, "pages")))
    page = F.expr("(record_id - 1) div 2")
    return found.select(
        page.alias("page_id"), "canonical_url", (F.expr("source_id div 2")).alias("source_page_id"), "status", revisits.headers_text(F.col("headers")).alias("headers")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, settings = toxicity.fit(docs, table(spark, sf_dir, "labels"), common.fold("doc_id", 3) != 1)
    scored = toxicity.score(docs, weights, settings)
    return scored.select(
        "doc_id", (common.fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_url_rules": op1_url_rules,
    "op2_context_mixing": op2_context_mixing,
    "op3_jaccard": op3_jaccard,
    "op4_perplexity": op4_perplexity,
    "op5_bpe": op5_bpe,
    "op6_decontaminate": op6_decontaminate,
    "op7_compression": op7_compression,
    "op8_token_counts": op8_token_counts,
    "op9_revisits": op9_revisits,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_pieces": op12_pieces,
    "op13_lexical": op13_lexical,
}

#: How the SQL side sees the crawl log and its revisits.
OP9_SQL = r"""
WITH stripped AS (
  SELECT page_id, md5(coalesce(html, '')) AS digest, 1700000000 + page_id * 60 AS asked_at, (page_id * 7919) % 50000 AS gap,
         regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages),
listed AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT starts_with(q, 'utm_'))) AS qs
  FROM stripped),
base AS (
  SELECT page_id, digest, asked_at, gap, asked_at + 1 + gap * 60 AS later,
         regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
         || CASE WHEN len(qs) > 0 THEN '?' || array_to_string(qs, '&') ELSE '' END AS u
  FROM listed),
answers AS (SELECT u, asked_at::HUGEINT * 10000000000 + page_id * 2 AS place, page_id, asked_at, gap, CASE WHEN page_id % 7 <> 0 THEN '"' || digest || '"' END AS tag FROM base),
asked AS (
  SELECT *, later::HUGEINT * 10000000000 + page_id * 2 + 1 AS place,
         CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id % 11 = 0 THEN '"other"' ELSE 'W/"' || digest || '"' END END AS tag
  FROM base),
met AS (
  SELECT a.page_id, a.u, a.later, a.asked_at - a.gap AS dated, a.tag AS tag, s.page_id AS source, s.tag AS stored, s.asked_at - s.gap AS stored_dated
  FROM asked a ASOF LEFT JOIN answers s ON a.u = s.u AND a.place > s.place),
judged AS (
  SELECT *, CASE WHEN source IS NULL THEN 'orphan'
                 WHEN stored IS NOT NULL AND tag IS NOT NULL THEN CASE WHEN stored = regexp_replace(tag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
                 WHEN stored_dated = dated THEN 'resolved' ELSE 'mismatch' END AS status
  FROM met)
SELECT page_id, u AS canonical_url, source AS source_page_id, status,
       CASE WHEN status = 'resolved' THEN
         'content-type: text/html' || chr(10) || 'date: ' || later || chr(10)
         || CASE WHEN coalesce(tag, stored) IS NOT NULL THEN 'etag: ' || coalesce(tag, stored) || chr(10) ELSE '' END
         || 'expires: ' || (later + 3600) || chr(10) || 'last-modified: ' || dated || chr(10) || 'server: origin' END AS headers
FROM judged
"""
#: Ranked search, plainly: every document that shares a term is scored.
OP13_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, total GROUP BY term, docs),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
ORACLES: dict[str, str] = {"op9_revisits": OP9_SQL, "op13_lexical": OP13_SQL}
