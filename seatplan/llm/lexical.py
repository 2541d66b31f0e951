"""Ranked lexical search of all documents for a set of items, by a dual-tree search with exact bounds.

Terms are runs of ASCII letters, digits and bytes beyond ASCII, only A-Z lower-cased. One pass over the whole texts
writes each document's length and its counts of the items' terms; counts over all documents then give the weights.
The search runs where the documents lie. A task builds a hierarchy over its items (halved by the term that splits
them best) and, batch after batch, one over its documents (sorted by whose term weighs most, leaves of ``leaf``
documents, ``fan`` children a node). Nodes of items hold which terms their items have, nodes of documents the largest
value of every term: the sum of these values over a pair of nodes bounds every score below it. A pair whose bound lies
under the weakest kth score of its items is dropped with all its documents; so is one that equals it where no key is
small enough to win the tie. Pairs of leaves are scored exactly, in whole numbers. Each task returns at most ``k``
documents an item, which Spark ranks.

Items are taken in blocks of about ``block_terms`` terms; a block, and nothing that grows with the documents, travels
to the tasks. More items make more passes.

Items and documents without a term (null, empty) have no result. Repeated items each get their own ranks, repeated
documents a rank each. Ties go to the lesser key; null keys come last. Keys of documents are whole numbers below
2**63 - 1. Long texts are worked on in parts. Only ``key``, ``item_key`` and ``text`` are read, so other columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatplan.llm import common, words

LAST = np.iinfo(np.int64).max
FIRST = np.iinfo(np.int64).min
#: Everything in ASCII that is neither a letter nor a digit.
BREAKS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
VECTORS = "id long, n long, terms array<int>, counts array<long>"


@dataclass(frozen=True)
class Settings:
    k: int = 50
    block_terms: int = 1 << 17
    leaf: int = 16
    fan: int = 4
    #: Cells of the matrix of a batch of documents.
    cells: int = 1 << 22


# ---- terms


def parts(texts: pa.Array, limit: int = words.BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-cased bytes, offsets and rows of the column in blocks; a text beyond ``limit`` bytes is cut at breaks."""
    for block in words.blocks(texts, limit):
        data = words.LOWER[block.data]
        if block.rows > 1 or len(data) <= limit:
            yield data, block.offsets, np.arange(block.first, block.first + block.rows)
            continue
        at = 0
        while at < len(data):
            to = at + limit
            while to < len(data):
                near = np.flatnonzero(BREAKS[data[to : to + limit]])
                if len(near):
                    to += int(near[0])
                    break
                to += limit
            piece = data[at:to]
            yield piece, np.array([0, len(piece)]), np.array([block.first])
            at = to


def hashed(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: its rows, their numbers of terms, and row and hash of every term."""
    for data, offsets, rows in parts(texts):
        found = words.words(words.Block(data, offsets, 0), BREAKS)
        yield rows, found.counts, rows[found.row], words.hashes(data, found.starts, found.ends)


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order], first)


def item_terms(items: DataFrame, item_key: str, text: str) -> DataFrame:
    """``(item, key, terms)``: a number for each item, and the hashes of its terms, each once."""
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_key).alias("key"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for _, _, row, h in hashed(batch.column("_text")):
                for r in np.unique(row):
                    lists[r].append(np.unique(h[row == r]))
            terms = [np.unique(np.concatenate(x)).view(np.int64) if x else np.zeros(0, np.int64) for x in lists]
            yield pa.record_batch([batch.column("item"), batch.column("key"), pa.array(terms, pa.list_(pa.int64()))], names=["item", "key", "terms"])

    kind = items.schema[item_key].dataType.simpleString()
    return numbered.mapInArrow(run, f"item long, key {kind}, terms array<long>")


def vectors(docs: DataFrame, vocabulary: np.ndarray, key: str, text: str) -> DataFrame:
    """``(id, n, terms, counts)`` of every document with a term: its length and its counts of the vocabulary's terms."""
    size = max(len(vocabulary), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = words.Lookup(vocabulary)
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            keys, counts = [], []
            for rows, many, row, h in hashed(batch.column("_text")):
                n[rows] += many
                at = lookup(h)
                hit = at >= 0
                found, times = folded(row[hit] * size + at[hit], np.ones(int(hit.sum()), dtype=np.int64))
                keys.append(found)
                counts.append(times)
            if not keys:
                continue
            found, times = folded(np.concatenate(keys), np.concatenate(counts))
            each = np.bincount(found // size, minlength=batch.num_rows)
            out = pa.record_batch(
                [batch.column("_id"), pa.array(n), words.cut((found % size).astype(np.int32), each), words.cut(times, each)], names=["id", "n", "terms", "counts"]
            )
            yield out.filter(pa.array(n > 0))

    given = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    return given.mapInArrow(run, VECTORS)


# ---- hierarchies


@dataclass(frozen=True)
class Items:
    """A block of items: their numbers, their terms as places in the vocabulary (``ends`` closes each item's), and the terms' weights."""

    numbers: np.ndarray
    ends: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


class ItemTree:
    """Binary hierarchy. Node 0 is the root; a leaf is one item. Every node holds the terms of its items, each once."""

    def __init__(self, items: Items):
        self.items = items
        n = len(items.numbers)
        starts = np.append(0, items.ends[:-1])
        of = [items.terms[a:b] for a, b in zip(starts, items.ends, strict=True)]
        owner = np.repeat(np.arange(n), items.ends - starts)
        self.left: list[int] = []
        self.right: list[int] = []
        self.item: list[int] = []
        lists: list[np.ndarray] = []
        order: list[int] = []
        open_nodes = [(np.arange(n), -1, False)]
        inside = np.zeros(n, dtype=bool)
        while open_nodes:
            members, parent, is_right = open_nodes.pop()
            node = len(self.item)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            self.left.append(-1)
            self.right.append(-1)
            if len(members) == 1:
                self.item.append(int(members[0]))
                order.append(int(members[0]))
                lists.append(of[members[0]])
                continue
            self.item.append(-1)
            terms, counts = np.unique(np.concatenate([of[m] for m in members]), return_counts=True)
            lists.append(terms)
            half = len(members) // 2
            best = int(np.argmin(np.abs(counts - half))) if len(terms) else 0
            if len(terms) and 0 < counts[best] < len(members):
                inside[:] = False
                inside[owner[items.terms == terms[best]]] = True
                first, second = members[inside[members]], members[~inside[members]]
            else:
                first, second = members[:half], members[half:]
            open_nodes += [(second, node, True), (first, node, False)]
        self.left_of, self.right_of, self.item_of = np.array(self.left), np.array(self.right), np.array(self.item)
        self.node_ends = np.cumsum([len(x) for x in lists])
        self.node_terms = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        #: Where a term first occurs among the items in tree order.
        self.place = np.full(len(items.weights), n, dtype=np.int64)
        for at, m in reversed(list(enumerate(order))):
            self.place[of[m]] = at

    def spread(self, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every node: the weakest kth score of its items, and the greatest key that could still win a tie."""
        low, late = np.empty(len(self.item_of), dtype=np.int64), np.empty(len(self.item_of), dtype=np.int64)
        for node in range(len(self.item_of) - 1, -1, -1):  # children have greater numbers
            if self.item[node] >= 0:
                low[node], late[node] = scores[self.item[node]], ids[self.item[node]]
            else:
                a, b = self.left[node], self.right[node]
                low[node], late[node] = min(low[a], low[b]), max(late[a], late[b])
        return low, late


@lru_cache(maxsize=1)
def _tree(packed: bytes) -> ItemTree:
    import pickle

    return ItemTree(pickle.loads(packed))


class Best:
    """The ``k`` best documents of each item so far, by falling score and rising key."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.item, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.low, self.late = np.zeros(n, dtype=np.int64), np.full(n, FIRST)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, item: np.ndarray, score: np.ndarray, key: np.ndarray) -> bool:
        """True if the thresholds may have risen."""
        self.new.append((item, score, key))
        self.waiting += len(item)
        if self.waiting < max(4096, len(self.item) // 4):
            return False
        self.settle()
        return True

    def settle(self) -> None:
        if not self.new:
            return
        item, score, key = (np.concatenate([mine, *theirs]) for mine, theirs in zip((self.item, self.score, self.id), zip(*self.new, strict=True), strict=True))
        self.new, self.waiting = [], 0
        order = np.lexsort((key, -score, item))
        item, score, key = item[order], score[order], key[order]
        first = np.searchsorted(item, np.arange(self.n))
        keep = np.arange(len(item)) - first[item] < self.k
        self.item, self.score, self.id = item[keep], score[keep], key[keep]
        many = np.bincount(self.item, minlength=self.n)
        ends = np.cumsum(many)
        full = np.flatnonzero(many == self.k)
        self.low[full], self.late[full] = self.score[ends[full] - 1], self.id[ends[full] - 1]


def values(n: np.ndarray, terms: np.ndarray, counts: np.ndarray, row: np.ndarray, weights: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each counted term adds to a score."""
    m = 50 + (50 * n * documents) // length
    return weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m[row]))


def search_batch(tree: ItemTree, best: Best, ids: np.ndarray, row: np.ndarray, terms: np.ndarray, value: np.ndarray, low: np.ndarray, late: np.ndarray, settings: Settings) -> bool:
    """One batch of documents, in the order of ``ids``: entries ``(row, term, value)`` sorted by row."""
    local, column = np.unique(terms, return_inverse=True)
    leaves = -(-len(ids) // settings.leaf)
    matrix = np.zeros((len(local), leaves * settings.leaf), dtype=np.int64)
    matrix[column, row] = value
    matrix = matrix.reshape(len(local), leaves, settings.leaf)
    padded = np.full(leaves * settings.leaf, LAST)
    padded[: len(ids)] = ids
    levels, least = [matrix.max(2)], [padded.reshape(leaves, settings.leaf).min(1)]
    while levels[-1].shape[1] > 1:
        wide = levels[-1].shape[1]
        cuts = np.arange(0, wide, settings.fan)
        levels.append(np.maximum.reduceat(levels[-1], cuts, axis=1))
        least.append(np.minimum.reduceat(least[-1], cuts))
    # the items' terms as columns of this batch
    column_of = np.full(len(tree.items.weights), -1, dtype=np.int64)
    column_of[local] = np.arange(len(local))
    held = column_of[tree.node_terms]
    kept = np.append(0, np.cumsum(held >= 0))
    ends = kept[tree.node_ends]
    starts = np.append(0, ends[:-1])
    held = held[held >= 0]

    def sums(node: np.ndarray, below: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Of each pair: the sum over the item node's terms of ``of[term, below]``."""
        many = (ends - starts)[node]
        out = np.zeros((len(node), *of.shape[2:]), dtype=np.int64)
        wide = int(np.prod(of.shape[2:], dtype=np.int64))
        at = 0
        while at < len(node):
            to = max(at + 1, int(np.searchsorted(np.cumsum(many[at:]), settings.cells // wide, "right")) + at)
            size = many[at:to]
            some = np.flatnonzero(size)
            if len(some):
                first = np.cumsum(size[some]) - size[some]
                index = np.repeat(starts[node[at:to]][some] - first, size[some]) + np.arange(size.sum())
                taken = of[held[index], np.repeat(below[at:to][some], size[some])]
                out[at + some] = np.add.reduceat(taken, first, axis=0)
            at = to
        return out

    node, below, depth = np.array([0]), np.array([0]), len(levels) - 1
    while len(node):
        bound = sums(node, below, levels[depth])
        open_pair = (bound > low[node]) | ((bound == low[node]) & (least[depth][below] < late[node]))
        node, below = node[open_pair], below[open_pair]
        single = tree.item_of[node] >= 0
        if depth == 0 and single.all():
            break
        # both sides step down; an item, or a leaf of documents, waits for the other
        node = np.concatenate([node[single], tree.left_of[node[~single]], tree.right_of[node[~single]]])
        below = np.concatenate([below[single], below[~single], below[~single]])
        if depth:
            depth -= 1
            wide = levels[depth].shape[1]
            node = np.repeat(node, settings.fan)
            below = (below[:, None] * settings.fan + np.arange(settings.fan)).ravel()
            node, below = node[below < wide], below[below < wide]
    if not len(node):
        return False
    score = sums(node, below, matrix)
    item = tree.item_of[node]
    keys = padded.reshape(leaves, settings.leaf)[below]
    good = (score > 0) & ((score > best.low[item][:, None]) | ((score == best.low[item][:, None]) & (keys < best.late[item][:, None])))
    at, _ = np.nonzero(good)
    return best.add(item[at], score[good], keys[good])


def search(found: DataFrame, items: Items, documents: int, length: int, settings: Settings) -> DataFrame:
    """``(item, id, score)``: each task's best documents of every item."""
    import pickle

    packed = pickle.dumps(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree(packed)
        best = Best(len(items.numbers), settings.k)
        low, late = tree.spread(best.low, best.late)
        for batch in batches:
            lists = batch.column("terms")
            offsets = lists.offsets.to_numpy()
            many = np.diff(offsets).astype(np.int64)
            terms, counts = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            ids = pc.fill_null(batch.column("id"), LAST).to_numpy()
            row = np.repeat(np.arange(len(ids)), many)
            value = values(batch.column("n").to_numpy(), terms, counts, row, items.weights, documents, length)
            # documents without a value go, the others lie by the item whose term weighs most in them
            some = np.flatnonzero(np.bincount(row[value > 0], minlength=len(ids)))
            if not len(some):
                continue
            heavy = np.lexsort((-value, row))
            top = terms[heavy[np.append(True, row[heavy][1:] != row[heavy][:-1])]] if len(row) else terms
            place = np.full(len(ids), LAST)
            place[np.flatnonzero(many)] = tree.place[top]
            order = some[np.argsort(place[some], kind="stable")]
            starts = np.cumsum(many) - many
            at = 0
            while at < len(order):
                # as many documents as keep the matrix small: its columns are at most the terms met
                reach = order[at : at + 64 * settings.leaf]
                wide = np.minimum(np.cumsum(many[reach]), len(items.weights)) * np.arange(1, len(reach) + 1)
                take = max(1, int(np.searchsorted(wide, settings.cells, "right")))
                own = reach[:take]
                size = many[own]
                first = np.cumsum(size) - size
                index = np.repeat(starts[own] - first, size) + np.arange(size.sum())
                if search_batch(tree, best, ids[own], np.repeat(np.arange(take), size), terms[index], value[index], low, late, settings):
                    low, late = tree.spread(best.low, best.late)
                at += take
        best.settle()
        yield pa.record_batch(
            [pa.array(items.numbers[best.item]), pa.array(best.id, mask=best.id == LAST), pa.array(best.score)], names=["item", "id", "score"]
        )

    return found.mapInArrow(run, "item long, id long, score long")


def rank(docs: DataFrame, items: DataFrame, settings: Settings | None = None, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_key, rank, key, score``: each item's ``k`` best documents with a score above 0."""
    settings = settings or Settings()
    spark = docs.sparkSession
    common.small_batches(spark)
    listed = common.written(item_terms(items, item_key, text), "lexical-items")
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // settings.block_terms))
    result = None
    for b in range(blocks):
        rows = listed.filter((F.size("terms") > 0) & (F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)).select("item", "terms").orderBy("item").collect()
        if not rows:
            continue
        terms = [np.array(r["terms"], dtype=np.int64).view(np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(terms))
        found = common.written(vectors(docs, vocabulary, key, text), "lexical-vectors")
        sizes = found.agg(F.count("n").alias("documents"), F.sum("n").alias("length")).first()
        if not sizes["documents"]:
            continue
        held = np.zeros(len(vocabulary), dtype=np.int64)
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            held[r["term"]] = r["count"]
        n = sizes["documents"]
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in held], dtype=np.int64)
        block = Items(
            np.array([r["item"] for r in rows], dtype=np.int64), np.cumsum([len(t) for t in terms]),
            np.searchsorted(vocabulary, np.concatenate(terms)).astype(np.int64), weights,
        )
        best = search(found, block, n, sizes["length"], settings)
        result = best if result is None else result.unionByName(best)
    kind = items.schema[item_key].dataType.simpleString()
    if result is None:
        return spark.createDataFrame([], f"`{item_key}` {kind}, rank int, `{key}` long, score long")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = result.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= settings.k)
    named = listed.select("item", F.col("key").alias("_name"))
    return ranked.join(named, "item").select(F.col("_name").alias(item_key), "rank", F.col("id").alias(key), "score")
