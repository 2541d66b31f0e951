"""URL filters: explicit host and path rules, and association rules mined from labelled URLs, in DataFrame functions only.

Tokens of a URL are its host's labels, its whole host, its path segments and its query keys. A rule is a combination of
tokens that ``rows`` bad rows hold, however many are labelled, and that is bad with ``confidence``; one of which a part
is already a rule is dropped. What can be in no such rule, or in none of more than one token, is left out before:

- Equal token sets are one row with a weight, and tokens of fewer than ``rows`` bad rows go.
- Tokens that all labelled rows hold together or not at all are one item: each stands for all in every rule.
- An item that is a rule by itself goes; a larger rule with it would be dropped.
- FP-growth finds the frequent combinations of the other items, over bad rows only (a set counts ``rows`` times at most,
  which decides the same); confidence is counted by a join with all labelled sets, through an index on rare items.
- Combinations double with every item, so where a bad row still has more than ``widest`` items, those of its items that no
  bad row parts are bundled: rules then ask for all of a bundle, not for parts of it.

Rules are matched by an inverted index: each hangs on its rarest item, a URL meets the rules of its own items only, and
one that holds all of a rule's items is blocked. Work is done once for each distinct URL.

Null, empty and relative URLs have an empty host and path, match nothing and are allowed. Repeated rows are judged alike.
Keys whose labels disagree, and null keys, teach nothing. Without bad examples nothing is mined. Long URLs have many
tokens and are treated alike. Of the pages only ``key`` and ``url`` are read, so other columns never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    rows: int = 10
    confidence: float = 0.6
    #: Items of one bad row beyond which those that always go together there are bundled.
    widest: int = 16
    #: Whether pages that an explicit rule decides teach as well, by its verdict.
    learn_from_rules: bool = False


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Up to the first of ``/ ? #``, with A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    query = F.regexp_extract(_rest(url), "^[^?#]*\\?([^#]*)", 1)
    kinds = [
        F.transform(F.split(host(url), "\\."), lambda x: F.concat(F.lit("h:"), x)),
        F.array(F.concat(F.lit("d:"), host(url))),
        F.transform(F.split(path(url), "/"), lambda x: F.concat(F.lit("p:"), x)),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))),
    ]
    return F.array_distinct(F.filter(F.concat(*kinds), lambda x: F.length(x) > 2))


def by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(_url, rule, verdict)`` of the longest fitting rule ``(verdict, host, path)``: host or a subdomain, path prefix."""
    named = rules.select("verdict", F.col("host").alias("_suffix"), F.col("path").alias("_prefix"), F.concat("host", "path").alias("rule"))
    labels = F.split("_host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = urls.select("_url", "_path", F.explode(suffixes).alias("_suffix")).join(named, "_suffix").filter(F.col("_path").startswith(F.col("_prefix")))
    return met.groupBy("_url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("_best")).select("_url", "_best.rule", "_best.verdict")


def _same_rows(row: str) -> list[Column]:
    """Sums that are equal for equal sets of rows."""
    return [F.sum(F.xxhash64(row, F.lit(k)).cast("decimal(38,0)")).alias(f"_f{k}") for k in (1, 2)]


def _count(found: DataFrame, sets: DataFrame) -> DataFrame:
    """``(items, n, total)``: bad and all rows that hold all of ``items``; each combination meets the rows of its rarest item."""
    posted = sets.select("_row", "_bad", "_all", "_items", F.explode("_items").alias("_on"))
    apart = found.select("items", F.explode("items").alias("_on"))
    rare = apart.join(posted.groupBy("_on").agg(F.count("*").alias("_df")), "_on").groupBy("items").agg(F.min(F.struct("_df", "_on")).alias("_least"))
    hung = rare.select("items", F.col("_least._on").alias("_on"))
    met = posted.join(hung, "_on").filter(F.size(F.array_except("items", "_items")) == 0)
    return met.groupBy("items").agg(F.sum("_bad").alias("n"), F.sum("_all").alias("total"))


def _bundled(bad: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The bad rows ``(_row, _copies, _items)``, and ``(bundle, _item)`` of what was bundled in them."""
    wide = bad.filter(F.size("_items") > settings.widest).select(F.explode("_items").alias("_item")).distinct()
    prints = bad.select("_row", F.explode("_items").alias("_item")).join(wide, "_item").groupBy("_item").agg(*_same_rows("_row"))
    least = prints.groupBy("_f1", "_f2").agg(F.min("_item").alias("bundle"))
    bundles = common.written(prints.join(least, ["_f1", "_f2"]).select("bundle", "_item"), "url-bundles")
    renamed = (
        bad.select("_row", "_copies", F.explode("_items").alias("_item")).join(bundles, "_item", "left")
        .groupBy("_row", "_copies").agg(F.collect_set(F.coalesce("bundle", "_item")).alias("_items"))
    )
    return renamed, bundles


def mine(examples: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Rules ``(items, confidence, n)`` that imply a bad URL, and the item ``(_on, item)`` of every token they can hold.

    ``examples`` holds ``_tokens`` and ``_bad``.
    """
    s = settings
    alike = examples.groupBy(F.array_sort("_tokens").alias("_tokens")).agg(F.sum(F.col("_bad").cast("long")).alias("_bad"), F.count("*").alias("_all"))
    alike = common.written(alike.withColumn("_row", F.monotonically_increasing_id()), "url-examples")
    spread = alike.select("_row", "_bad", "_all", F.explode("_tokens").alias("_on"))
    held = spread.groupBy("_on").agg(F.sum("_bad").alias("_bad"), F.sum("_all").alias("_all"), *_same_rows("_row")).filter(F.col("_bad") >= s.rows)
    least = held.groupBy("_f1", "_f2").agg(F.min("_on").alias("item"))
    named = common.written(held.join(least, ["_f1", "_f2"]).select("_on", "item", "_bad", "_all"), "url-tokens")
    sure = F.col("_bad") >= s.confidence * F.col("_all")
    single = named.filter((F.col("_on") == F.col("item")) & sure).select(F.array("item").alias("items"), (F.col("_bad") / F.col("_all")).alias("confidence"), F.col("_bad").alias("n"))
    items = named.filter(~sure).select("_on", "item")
    sets = spread.join(items, "_on").groupBy("_row", "_bad", "_all").agg(F.collect_set("item").alias("_items"))
    sets = common.written(sets, "url-items")
    bad = sets.filter("_bad > 0").select("_row", F.least("_bad", F.lit(s.rows)).cast("int").alias("_copies"), "_items")
    bad, bundles = _bundled(bad, s)
    taught = common.written(bad.select("_items", F.explode(F.sequence(F.lit(1), "_copies"))).select("_items"), "url-bad")
    n = taught.count()
    # the miner rounds up to whole rows; half a row less keeps the product from passing the bound
    found = FPGrowth(itemsCol="_items", minSupport=min(1.0, (s.rows - 0.5) / max(n, 1))).fit(taught).freqItemsets
    found = common.written(found.select("items", F.monotonically_increasing_id().alias("_set")), "url-sets")
    whole = found.select("_set", F.explode("items").alias("bundle")).join(bundles, "bundle", "left").groupBy("_set").agg(F.sort_array(F.collect_set(F.coalesce("_item", "bundle"))).alias("items"))
    counted = _count(common.written(whole.filter(F.size("items") > 1).select("items").distinct(), "url-found"), sets)
    several = counted.filter((F.col("n") >= s.rows) & (F.col("n") >= s.confidence * F.col("total"))).select("items", (F.col("n") / F.col("total")).alias("confidence"), "n")
    rules = common.written(single.unionByName(several), "url-rules")
    # a rule of which a part is a rule adds nothing; a part hangs on the item that the fewest rules have
    apart = rules.select("items", F.explode("items").alias("_on"))
    rare = apart.join(apart.groupBy("_on").agg(F.count("*").alias("_df")), "_on").groupBy("items").agg(F.min(F.struct("_df", "_on")).alias("_least"))
    part = rare.select(F.col("items").alias("_part"), F.col("_least._on").alias("_on"))
    wider = (
        apart.join(part, "_on")
        .filter((F.size("_part") < F.size("items")) & (F.size(F.array_except("_part", "items")) == 0))
        .select("items")
        .distinct()
    )
    return rules.join(wider, "items", "left_anti"), named.select("_on", "item")


def by_mined(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """``(_url, mined)``: URLs (with ``_tokens``) that hold all items of a rule, through an index on each rule's rarest item."""
    holding = urls.select("_url", F.explode("_tokens").alias("_on")).join(items, "_on").groupBy("_url").agg(F.collect_set("item").alias("_items"))
    posted = holding.select("_url", "_items", F.explode("_items").alias("_on"))
    hung = (
        rules.select("items", F.explode("items").alias("_on"))
        .join(posted.groupBy("_on").agg(F.count("*").alias("_df")), "_on")
        .groupBy("items")
        .agg(F.min(F.struct("_df", "_on")).alias("_least"))
        .select("items", F.col("_least._on").alias("_on"))
    )
    met = posted.join(hung, "_on").filter(F.size(F.array_except("items", "_items")) == 0)
    return met.groupBy("_url").agg(F.min(F.array_join("items", " ")).alias("mined"))


def judge(pages: DataFrame, rules: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "page_id", label_key: str = "doc_id") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``mined`` (the mined rule that applies, if any) of every page.

    ``rules`` is ``(verdict, host, path)``; ``labels`` marks keys of pages with ``quality`` 0 or 1. Where an explicit rule
    teaches (``learn_from_rules``), its verdict goes before the label. A mined rule is named by its items' least tokens.
    """
    given = pages.select(F.col(key).alias(key), F.coalesce("url", F.lit("")).alias("_url"))
    marked = (
        labels.filter(F.col(label_key).isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col(label_key).alias(key))
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
        .filter("_low = _high")
        .select(key, (1 - F.col("_low")).alias("_bad"))
    )
    s = settings or Settings()
    urls = given.select("_url").distinct().withColumns({"_host": host(F.col("_url")), "_path": path(F.col("_url")), "_tokens": tokens(F.col("_url"))})
    named = common.written(by_rules(urls, rules), "url-named")
    examples = given.join(marked, key).select("_url", "_bad")
    if s.learn_from_rules:
        ruled = given.join(named, "_url").select("_url", (F.col("verdict") == "block").cast("int").alias("_bad"))
        examples = examples.join(named, "_url", "left_anti").unionByName(ruled)
    mined = by_mined(urls, *mine(examples.select(tokens(F.col("_url")).alias("_tokens"), "_bad"), s))
    verdict = F.coalesce("verdict", F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    judged = urls.select("_url", "_host", "_path").join(named, "_url", "left").join(mined, "_url", "left")
    return given.join(judged, "_url").select(key, F.col("_host").alias("host"), F.col("_path").alias("path"), "rule", verdict.alias("verdict"), "mined")
