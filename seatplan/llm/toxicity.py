"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of bytes other than white space and ASCII punctuation, A-Z lower-cased. Features of a text are its
distinct words, word pairs, and pairs with one word between, hashed into ``2**bits`` coordinates; each is present or not.
At most ``sample`` labelled rows teach, those with the least hash of their key: one task sees them in that order,
``epochs`` times, with per-coordinate rates. (Means of models from several shards were tried: every shard sees too few
rows of a rare word, and recall on held-out rows fell from 0.7 to 0.5.) L1 leaves few weights, which makes the broadcast
small; ``2**bits`` at most.

Null and empty texts have no features and get the score of the bias. Repeated rows are scored alike. Without labelled
rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common
from seatplan.llm.words import LOWER, WHITE_OR_MARK, Block, U, blocks, hashes, mix, words


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    epochs: int = 5
    #: Labelled rows that teach, at most.
    sample: int = 16_000


def features(block: Block, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all rows' words, pairs and skip pairs, row after row, and their number in each row; not yet distinct."""
    low = Block(LOWER[block.data], block.offsets, block.first)
    found = words(low, WHITE_OR_MARK)
    h, row = hashes(low.data, found.starts, found.ends), found.row
    rows, grams = [row], [h]
    for gap in (1, 2):
        same = row[gap:] == row[:-gap] if len(row) > gap else np.zeros(0, dtype=bool)
        grams.append(mix(h[:-gap][same] * U(2 * gap + 1) + h[gap:][same] * U(0x9E3779B97F4A7C15)) if len(same) else h[:0])
        rows.append(row[:-gap][same] if len(same) else row[:0])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return (np.concatenate(grams)[order] >> U(64 - bits)).astype(np.int64), np.bincount(row, minlength=block.rows)


class Ftrl:
    def __init__(self, s: Settings):
        self.s, self.z, self.n = s, np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g


def train(sample: DataFrame, settings: Settings) -> DataFrame:
    """Weights ``(at, w)``; the bias stands at ``2**bits``. ``sample`` is ``common.labelled``'s.

    Features are made where the texts are; the task that learns gets only these, sorted by Spark, and never a text.
    """
    s, kind = settings, sample.schema["_key"].dataType.simpleString()
    names = ["_order", "_key", "_label", "_at"]

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part, examples = batch.slice(begin, 256), []
                for block in blocks(part.column("_text")):
                    at, counts = features(block, s.bits)
                    examples += [np.append(np.unique(x), 1 << s.bits).astype(np.int32) for x in np.split(at, np.cumsum(counts)[:-1])]
                yield pa.record_batch([*[part.column(c) for c in names[:-1]], pa.array(examples, pa.list_(pa.int32()))], names=names)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, labels = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("_at")
            sizes = pc.list_value_length(lists).to_numpy()
            examples += np.split(lists.flatten().to_numpy(), np.cumsum(sizes)[:-1])
            labels += batch.column("_label").to_pylist()
        model = Ftrl(s)
        for _ in range(s.epochs):
            for at, label in zip(examples, labels, strict=True):
                model.learn(at, label)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(at.astype(np.int64)), pa.array(w[at])], names=["at", "w"])

    made = common.written(sample.mapInArrow(coordinates, f"_order long, _key {kind}, _label int, _at array<int>"), "toxicity-examples")
    return made.coalesce(1).sortWithinPartitions(*names).mapInArrow(learn, "at long, w double")


def score(docs: DataFrame, weights: DataFrame, settings: Settings, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` of every row."""
    return docs.select(*keep, _scorer(docs, weights, settings)("text").alias("score"))


def below(docs: DataFrame, weights: DataFrame, settings: Settings, bound: float) -> DataFrame:
    """The rows that score less than ``bound``, as they are, whatever their columns are called."""
    rows = docs.select(F.struct("*").alias("_doc"), _scorer(docs, weights, settings)("text").alias("_score"))
    return rows.filter(F.col("_score") < bound).select("_doc.*")


def _scorer(docs: DataFrame, weights: DataFrame, settings: Settings):
    table = weights.toArrow()
    dense = np.zeros((1 << settings.bits) + 1, dtype=np.float32)
    dense[table["at"].to_numpy()] = table["w"].to_numpy()
    model, bits = docs.sparkSession.sparkContext.broadcast(dense), settings.bits

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        w, out = model.value, [np.zeros(0)]
        for block in blocks(texts):
            at, counts = features(block, bits)
            row = np.repeat(np.arange(block.rows), counts)
            heavy = w[at] != 0
            hit = np.unique((row[heavy] << (bits + 1)) + at[heavy])
            total = np.bincount(hit >> (bits + 1), weights=w[hit & ((1 << (bits + 1)) - 1)], minlength=block.rows)
            out.append(1 / (1 + np.exp(-np.clip(total + w[1 << bits], -35, 35))))
        return pa.array(np.concatenate(out))

    return scored


def fit(docs: DataFrame, labels: DataFrame, teaches: Column, settings: Settings | None = None) -> tuple[DataFrame, Settings]:
    """A model from the labelled rows for which ``teaches`` holds."""
    settings = settings or Settings()
    common.small_batches(docs.sparkSession)
    return train(common.labelled(docs, labels, "toxic", teaches, settings.sample), settings), settings
