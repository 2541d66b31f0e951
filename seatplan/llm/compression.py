"""Quality by compression: one zstandard dictionary of good texts, one of bad texts, and which of them helps more.

The labelled sample (at most ``sample`` rows of each label, those with the least hash of their key) is halved by hash:
one half makes the dictionaries, the other the calibration, so that it sees sizes of texts that no dictionary holds.
A dictionary is made of at most ``drawn`` times its size: pieces from the whole length of the texts, in an order given by
a hash of key and place.
A text is compressed whole, in pieces of ``piece`` bytes that know only the dictionary, never each other. Its measure
is the normalised size difference ``(bad - good) / (bad + good)``; a logistic curve over it is the calibration.

Null and empty texts have measure 0. Repeated rows are scored alike. Where the sample lacks a label or is too small for
dictionaries, every score is the share of good rows in it (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common
from seatplan.llm.words import U, mix


@dataclass(frozen=True)
class Settings:
    #: Labelled rows of each label that teach, at most.
    sample: int = 6_000
    dictionary: int = 1 << 16
    #: Bytes a dictionary is made of, as a multiple of its size.
    drawn: int = 40
    piece: int = 1 << 9
    level: int = 3


def pieces(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


def _shuffled(cut: list[bytes], order: int) -> list[bytes]:
    place = mix(np.arange(len(cut), dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(order % (1 << 64)))
    return [cut[i] for i in np.argsort(place, kind="stable")]


def _dictionary(texts: list[bytes], orders: list[int], s: Settings) -> bytes:
    """Texts take turns, so that a few long ones do not fill the dictionary; each gives its pieces in hashed order."""
    cuts, chosen, room = [_shuffled(pieces(t, s.piece), o) for t, o in zip(texts, orders, strict=True)], [], s.dictionary * s.drawn
    for turn in range(max(map(len, cuts), default=0)):
        for one in cuts:
            if turn < len(one) and room > 0:
                chosen.append(one[turn])
                room -= len(one[turn])
        if room <= 0:
            break
    try:
        return zstandard.train_dictionary(s.dictionary, chosen, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Measure:
    def __init__(self, good: bytes, bad: bytes, s: Settings):
        self.s, self.known = s, bool(good and bad)
        if self.known:
            self.by = []
            for raw in (good, bad):
                book = zstandard.ZstdCompressionDict(raw)
                book.precompute_compress(level=s.level)
                self.by.append(zstandard.ZstdCompressor(dict_data=book, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: bytes) -> float:
        if not self.known or not text:
            return 0.0
        good, bad = (sum(len(c.compress(p)) for p in pieces(text, self.s.piece)) for c in self.by)
        return (bad - good) / (bad + good)


def design(measure: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(measure)), measure * 10])


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-3] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    curve: np.ndarray
    settings: Settings


def fit(docs: DataFrame, labels: DataFrame, teaches: Column, settings: Settings | None = None) -> Model:
    """Dictionaries are made in one task for each label and measures of the other half where its rows lie; what reaches
    the driver is two dictionaries of fixed size and one pair of numbers for each row of the bounded sample."""
    s = settings or Settings()
    common.small_batches(docs.sparkSession)
    sample = common.written(
        common.labelled(docs, labels, "quality", teaches & (F.col("quality") == 1), s.sample)
        .unionByName(common.labelled(docs, labels, "quality", teaches & (F.col("quality") == 0), s.sample)),
        "compression-sample",
    )
    half = F.pmod(F.xxhash64("_order"), F.lit(2)) == 0

    def make(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_order", "ascending"), ("_key", "ascending"), ("_text", "ascending")])
        book = _dictionary([t.encode() for t in rows["_text"].to_pylist()], rows["_order"].to_pylist(), s)
        return pa.table({"label": [rows["_label"][0].as_py()], "book": [book]})

    books = {r["label"]: bytes(r["book"]) for r in sample.filter(half).groupBy("_label").applyInArrow(make, "label long, book binary").collect()}
    good, bad = books.get(1, b""), books.get(0, b"")
    flat = Model(good, bad, np.zeros(2), s)
    rest = measured(sample.filter(~half).withColumn("text", F.col("_text")), flat, ("_key", "_label")).toArrow().to_pandas().sort_values("_key")
    y = rest["_label"].to_numpy(dtype=float)
    # the sample is balanced on purpose; rows count as often as their label occurs
    shares = labels.filter(teaches & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    if shares is None or not len(y) or y.min() == y.max() or not (good and bad):
        share = 0.5 if shares is None else min(max(float(shares), 1e-3), 1 - 1e-3)
        return Model(b"", b"", np.array([np.log(share / (1 - share)), 0]), s)
    curve = _calibrate(design(rest["measure"].to_numpy()), y)
    curve[0] += np.log(shares / (1 - shares)) - np.log(y.mean() / (1 - y.mean()))
    return Model(good, bad, curve, s)


def measured(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``measure``, ``bytes`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        of = Measure(m.good, m.bad, m.settings)
        for batch in batches:
            column, got, length = batch.column("_text").cast(pa.large_binary()), [], []
            for text in column:
                text = text.as_py() or b""
                got.append(of(text))
                length.append(len(text))
            measure, n = np.array(got, dtype=float), np.array(length, dtype=float)
            score = 1 / (1 + np.exp(-np.clip(design(measure) @ m.curve, -30, 30)))
            yield pa.record_batch(
                [*[batch.column(c) for c in keep], pa.array(measure), pa.array(n.astype(np.int64)), pa.array(score)],
                names=[*keep, "measure", "bytes", "score"],
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{kinds}, measure double, bytes long, score double")


score = measured
