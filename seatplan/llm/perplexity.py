"""Quality rules: counts of words, marks and repetitions, and bands of n-gram perplexity for each language.

The language model is a modified Kneser-Ney model over byte 4-grams, one for each language, of the text with A-Z
lower-cased and each run of white space taken as one space, none at its beginning; contexts before the text are spaces. All of it is counted
and weighted in Spark, over every 4-gram of every text, however many there are: counts, counts of counts, continuation
counts of the lower orders, and each 4-gram's probability, joined from order to order. Tasks get the ``grams`` most
frequent 4-grams as sorted hash arrays of a bounded size; a text's other 4-grams are joined with the rest of the table,
so only texts with rare ones take that way, and no 4-gram is left out.

A language's band is ``[q1 - width * spread, q3 + width * spread]`` of log10 perplexity over its different texts that pass
the base rules, each counted once; ``spread`` is ``q3 - q1``, but ``least_spread`` at least, so that near copies do not close
the band. A text outside is rejected. ``width`` is far out on purpose: clean texts stay. Bands are one row for each
language and are counted before they are shared; texts never move to meet them. A null language is a language of its own,
apart from ``''``. Null and empty texts have no words, so they fail the base rules; their perplexity is null. Repeated
rows are counted in the model and judged like any others; equal perplexities fall on the same side. An empty table gives
an empty result. ``passing`` carries rows as they are, whatever their columns are called; ``assess`` refuses to keep a
column named like one of its own. A text is worked on as one numpy block, about 100 bytes for each byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common
from seatplan.llm.words import LOWER, WHITE, Block, Lookup, U, blocks, cut, hashes, mix, tallied, windows, words

ORDER = 4
MARKS = np.zeros(256, dtype=bool)
MARKS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Settings:
    grams: int = 1 << 21
    width: float = 4.0
    least_spread: float = 0.02
    least_words: int = 50
    #: Languages up to which their bands and discounts are broadcast.
    languages: int = 10_000


def normal(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bytes lower-cased with runs of white space as one space, and the rows' new offsets."""
    inside = ~WHITE[block.data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    edges = block.offsets[:-1][np.diff(block.offsets) > 0]
    keep[edges] = inside[edges]
    sums = np.zeros(len(keep) + 1, dtype=np.int64)
    np.cumsum(keep, out=sums[1:])
    out = LOWER[block.data[keep]]
    out[~inside[keep]] = 32
    return out, sums[block.offsets]


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each byte, packed; what lies before a row is spaces."""
    key = data.astype(np.uint32)
    place = np.arange(len(data), dtype=np.uint32)
    place -= np.repeat(offsets[:-1].astype(np.uint32), np.diff(offsets))
    before = np.empty(len(data), dtype=np.uint32)
    for back in range(1, ORDER):
        before[:back] = 32
        before[back:] = data[:-back]
        before[place < back] = 32
        before <<= np.uint32(8 * back)
        key |= before
    return key


#: Bytes that are measured at once; what is held of each is some 60 times as large.
MEASURED = 1 << 18
LANGUAGE = 1 << 32


def _code(lang: str = "lang") -> Column:
    """31 bits for each language, above a 4-gram's 32."""
    return F.pmod(F.xxhash64(F.col(lang).isNull(), F.col(lang)), F.lit(1 << 31))


def _language(key: str = "key") -> Column:
    return F.expr(f"{key} div {LANGUAGE}")


def _suffix(order: int) -> Column:
    """The last ``order`` bytes of a key's gram, in its language."""
    return F.expr(f"(key div {LANGUAGE}) * {LANGUAGE} + (key & {(1 << 8 * order) - 1})")


def _context() -> Column:
    """A key's gram without its last byte, in its language."""
    return F.expr(f"(key div {LANGUAGE}) * {LANGUAGE} + shiftright(key & {LANGUAGE - 1}, 8)")


#: Counts of blocks that a task holds before it adds them up, and sends on at a time.
HELD, SENT = 1 << 19, 1 << 16


def merged(tallies: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The counts of some blocks added up, in small batches."""
    if not tallies:
        return
    key, n = (np.concatenate(x) for x in zip(*tallies, strict=True))
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    key, n = key[first].astype(np.int64), np.add.reduceat(n, first) if len(first) else n
    for at in range(0, len(key), SENT):
        yield pa.record_batch([pa.array(key[at : at + SENT]), pa.array(n[at : at + SENT])], names=["key", "n"])


def count(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(key, n)`` over all texts: a language and a 4-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            codes = batch.column("_code").to_numpy().astype(np.uint64)
            for block in blocks(batch.column("_text")):
                held.append(tallied(keys_of(block, codes)[0]))
                total += len(held[-1][0])
                if total >= HELD:
                    yield from merged(held)
                    held, total = [], 0
        yield from merged(held)

    counted = docs.select(F.col(text).alias("_text"), _code(lang).alias("_code")).mapInArrow(run, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def keys_of(block: Block, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all 4-grams of a block, in order, and the number of each row."""
    data, offsets = normal(block)
    size = np.diff(offsets)
    # in place, for keys are eight times as large as the texts
    found = grams(data, offsets)
    keys = np.repeat(codes[block.first : block.first + block.rows] << U(32), size)
    keys |= found
    return keys, size


def _discounts(level: DataFrame) -> DataFrame:
    """``(_language, _steps)``: the three discounts of every language, from its counts of counts."""
    of = [F.sum((F.col("n") == c).cast("double")).alias(f"_n{c}") for c in (1, 2, 3, 4)]
    y = F.expr("if(_n1 > 0 and _n2 > 0, _n1 / (_n1 + 2 * _n2), 0.5d)")
    step = lambda j: F.when(
        F.col(f"_n{j}") > 0, F.least(F.greatest(F.lit(float(j)) - (j + 1) * F.col("_y") * F.col(f"_n{j + 1}") / F.col(f"_n{j}"), F.lit(0.1)), F.lit(float(j)))
    ).otherwise(0.5 * j)
    return level.groupBy(_language().alias("_language")).agg(*of).withColumn("_y", y).select("_language", F.array(*[step(j) for j in (1, 2, 3)]).alias("_steps"))


@dataclass
class Model:
    """Of each order: ``(key, n, p)`` of every known gram, and ``(key, w)``, the weight that its lower order has behind a context."""

    orders: dict[int, DataFrame]
    weights: dict[int, DataFrame]

    def log10(self, keys: np.ndarray, lang: str | None = None, order: int = ORDER) -> np.ndarray:
        """log10 probabilities of some grams, known or not."""
        if not order:
            return np.full(len(keys), -np.log10(256))
        spark = self.orders[ORDER].sparkSession
        code = spark.range(1).select(F.lit(lang).cast("string").alias("lang")).select(_code()).first()[0] * LANGUAGE
        keys = keys.astype(np.int64)
        found = _looked_up(self.orders[order], code + keys, "p")
        weights = _looked_up(self.weights[order], code + (keys >> 8), "w")
        seen = np.array([k in found for k in code + keys])
        out = np.array([found.get(int(k), 1.0) for k in code + keys])
        if not seen.all():
            rest = keys[~seen]
            lower = 10 ** self.log10(rest & ((1 << 8 * (order - 1)) - 1), lang, order - 1)
            out[~seen] = lower * np.array([weights.get(int(k), 1.0) for k in code + (rest >> 8)])
        return np.log10(out)


def _looked_up(table: DataFrame, keys: np.ndarray, value: str) -> dict[int, float]:
    return {r["key"]: r[value] for r in table.filter(F.col("key").isin([int(k) for k in np.unique(keys)])).collect()}


def fit(docs: DataFrame, settings: Settings, text: str = "text", lang: str = "lang") -> Model:
    """Counts and weights of all orders, as written tables."""
    common.small_batches(docs.sparkSession)
    levels = {ORDER: common.written(count(docs, text, lang), f"grams-{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = common.written(levels[k + 1].groupBy(_suffix(k).alias("key")).agg(F.count("*").alias("n")), f"grams-{k}")
    orders: dict[int, DataFrame] = {}
    weights: dict[int, DataFrame] = {}
    for k in range(1, ORDER + 1):
        steps = common.checked(_discounts(levels[k]), settings.languages)
        level = levels[k].withColumn("_language", _language()).join(steps, "_language")
        level = level.withColumn("_off", F.col("_steps")[F.least("n", F.lit(3)).cast("int") - 1]).withColumn("_context", _context()).drop("_steps", "_language")
        context = level.groupBy("_context").agg(F.sum("n").alias("_total"), (F.sum("_off") / F.sum("n")).alias("w"))
        level = level.join(context, "_context").withColumn("_rest", _suffix(k - 1))
        if k == 1:
            level = level.withColumn("_p", F.lit(1 / 256))
        else:
            level = level.join(orders[k - 1].select(F.col("key").alias("_rest"), F.col("p").alias("_p")), "_rest")
        orders[k] = common.written(level.select("key", "n", ((F.col("n") - F.col("_off")) / F.col("_total") + F.col("w") * F.col("_p")).alias("p")), f"order-{k}")
        weights[k] = context.select(F.col("_context").alias("key"), "w")
    return Model(orders, weights)


@dataclass(frozen=True)
class Head:
    """The most frequent 4-grams in sorted arrays."""

    find: Lookup
    log10: np.ndarray


def _per_row(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value whether it is the first of its row, and how often its row has it."""
    key = mix(h + row.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    _, first, back, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    leads = np.zeros(len(key), dtype=bool)
    leads[first] = True
    return leads, n[back]


def counts(block: Block) -> dict[str, np.ndarray]:
    """The base counts of each row."""
    data, offsets, n = block.data, block.offsets, block.rows
    found = words(block)
    row = found.row
    starts_char = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(((data & 0xC0) != 0x80) & ~WHITE[data], out=starts_char[1:])
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(MARKS[data], out=marks[1:])
    # lines: from a row's start or a line feed to the next line feed or the row's end
    feeds = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    has_word = np.searchsorted(found.starts, end) > np.searchsorted(found.starts, begin)
    begin, end = begin[has_word], end[has_word]
    line_row = np.searchsorted(offsets, begin, "right") - 1
    leads, _ = _per_row(line_row, hashes(data, begin, end))
    # words in 3-word windows that the row has twice or more
    win, per_row = windows(hashes(data, found.starts, found.ends), found.counts, 3)
    win_row = np.repeat(np.arange(n), per_row)
    again = np.flatnonzero(_per_row(win_row, win)[1] > 1)
    covered = np.zeros(len(found.starts) + 1, dtype=bool)
    at = found.first[win_row[again]] + again - (np.cumsum(per_row) - per_row)[win_row[again]]
    for j in range(3):
        covered[at + j] = True
    return {
        "n_words": found.counts,
        "word_chars": starts_char[offsets[1:]] - starts_char[offsets[:-1]],
        "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]],
        "n_dup_lines": np.bincount(line_row[~leads], minlength=n),
        "n_repeat_words": np.bincount(row[covered[:-1]], minlength=n),
    }


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, model: Model, settings: Settings, keep: tuple[str, ...], text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``keep`` columns as one struct ``_doc``, and ``_m``: base counts, ``base_failed`` and ``log_ppl`` (log10 perplexity a byte) of every row.

    ``_lang`` and ``_same`` are hashes of its language and text.
    """
    table = model.orders[ORDER]
    top = table.orderBy(F.desc("n"), "key").limit(settings.grams).select("key", F.log10("p").alias("l")).toArrow().sort_by("key")
    head = Head(Lookup(top["key"].to_numpy()), top["l"].to_numpy())
    shared, least = docs.sparkSession.sparkContext.broadcast(head), settings.least_words
    kinds = {**dict.fromkeys(COLUMNS, "bigint"), "base_failed": "boolean", "size": "bigint", "total": "double", "rare": "array<bigint>", "times": "array<bigint>"}

    @F.arrow_udf(f"struct<{', '.join(f'{c}: {kind}' for c, kind in kinds.items())}>")
    def measured(texts: pa.Array, code: pa.Array) -> pa.Array:
        m, out, sizes, totals, rare, times = shared.value, [], [], [], [], []
        codes = code.to_numpy().astype(np.uint64)
        for block in blocks(texts, MEASURED):
            out.append(counts(block))
            keys, size = keys_of(block, codes)
            row = np.repeat(np.arange(block.rows), size)
            at = m.find(keys)
            known = at >= 0
            sizes.append(size)
            totals.append(np.bincount(row[known], weights=m.log10[at[known]], minlength=block.rows) if len(m.log10) else np.zeros(block.rows))
            order = np.lexsort((keys[~known], row[~known]))
            r, g = row[~known][order], keys[~known][order]
            first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (g[1:] != g[:-1]))) if len(r) else np.zeros(0, dtype=np.int64)
            each = np.bincount(r[first], minlength=block.rows)
            rare.append(cut(g[first].astype(np.int64), each))
            times.append(cut(np.diff(np.append(first, len(r))), each))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        base = {c: join([x[c] for x in out], np.int64) for c in COLUMNS}
        failed = (base["n_words"] < least) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
        lists = [pa.concat_arrays(x) if x else pa.array([], pa.list_(pa.int64())) for x in (rare, times)]
        columns = [*[pa.array(base[c].astype(np.int64)) for c in COLUMNS], pa.array(failed), pa.array(join(sizes, np.int64)), pa.array(join(totals, np.float64)), *lists]
        return pa.StructArray.from_arrays(columns, names=list(kinds))

    doc = F.struct(*[F.col(c) for c in keep]).alias("_doc")
    found = docs.select(doc, measured(F.col(text), _code(lang)).alias("_m"), _code(lang).alias("_lang"), F.xxhash64(text).alias("_same"))
    found = common.written(found.withColumn("_row", F.monotonically_increasing_id()), "perplexity")
    shared.destroy()
    plain = found.filter(F.size("_m.rare") == 0).withColumn("_more", F.lit(0.0))
    rest = found.filter(F.size("_m.rare") > 0)
    each = rest.select("_row", F.explode(F.arrays_zip(F.col("_m.rare").alias("key"), F.col("_m.times").alias("n"))).alias("_e")).select("_row", F.col("_e.key").alias("key"), F.col("_e.n").alias("_n"))
    more = each.join(table.select("key", F.log10("p").alias("_l")), "key").groupBy("_row").agg(F.sum(F.col("_n") * F.col("_l")).alias("_more"))
    every = plain.unionByName(rest.join(more, "_row")) if len(top) == settings.grams else plain
    ppl = F.when(F.col("_m.size") > 0, -(F.col("_m.total") + F.col("_more")) / F.col("_m.size"))
    return every.select("_doc", F.struct(*[F.col(f"_m.{c}").alias(c) for c in (*COLUMNS, "base_failed")], ppl.alias("log_ppl")).alias("_m"), "_lang", "_same")


def judge(measured: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``low``, ``high`` (the band of the row's language) and ``kept`` to ``_m``."""
    q = F.percentile_approx("log_ppl", [0.25, 0.75], 10_000)
    bands = (
        measured.filter("not _m.base_failed")
        .select("_lang", "_same", F.col("_m.log_ppl").alias("log_ppl"))
        .distinct()
        .groupBy("_lang")
        .agg(q.alias("_q"))
        .withColumn("_spread", settings.width * F.greatest(F.expr("_q[1] - _q[0]"), F.lit(settings.least_spread)))
        .select("_lang", (F.col("_q")[0] - F.col("_spread")).alias("_low"), (F.col("_q")[1] + F.col("_spread")).alias("_high"))
    )
    bands = common.checked(common.written(bands, "bands"), settings.languages)
    inside = F.coalesce(F.col("_m.log_ppl").between(F.col("_low"), F.col("_high")), F.lit(False))
    verdict = F.struct("_m.*", F.col("_low").alias("low"), F.col("_high").alias("high"), (~F.col("_m.base_failed") & inside).alias("kept"))
    return measured.join(bands, "_lang", "left").select("_doc", verdict.alias("_m"))


def assess(docs: DataFrame, settings: Settings | None = None, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` columns, measures and verdict of every row."""
    settings = settings or Settings()
    clash = {c.lower() for c in keep} & {*COLUMNS, "base_failed", "log_ppl", "low", "high", "kept"}
    if clash:
        raise ValueError(f"columns with the names of measures: {', '.join(sorted(clash))}")
    return judge(measure(docs, fit(docs, settings), settings, keep), settings).select("_doc.*", "_m.*")


def passing(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows that are kept, as they are."""
    settings = settings or Settings()
    return judge(measure(docs, fit(docs, settings), settings, tuple(docs.columns)), settings).filter("_m.kept").select("_doc.*")
