"""Exact Jaccard join of documents on word n-grams, with set relations used to skip work.

A document's set is its distinct runs of ``size`` words (A-Z lower-cased, words without white space); with fewer words,
the whole sequence is one. Two documents link when ``100 * intersection >= percent * union``.

1. How often each n-gram occurs is counted in ranges of hashes, from compressed sorted runs of each task. Two results of
   fixed size are shared: a bitmap of hashes that occur twice, and the ``frequent`` most frequent n-grams.
2. Each set is put in one global order: what occurs once, then what occurs more often, the frequent ones last by count.
   A set of which too few members occur elsewhere has no partner. Equal sets are one class from here on.
3. Index skipping: prefixes go into lists by n-gram and size block, entries by position; a block out of the size range is
   never met, and an entry whose position leaves too few members is skipped.
4. Answer skipping: every entry is first checked against the pivot of its list (the entry with the least position). What
   the pivot has joined into one component needs no further check where components are asked for alone; only pairs of
   different components that pass both filters are checked then, each exactly on its full sets.
5. Answers from a similar set (``count_links``): in each such component the set with the most answers so far becomes a
   star, and what links with it is written as differences from it; the rest get a second star, and so on. What most of a
   star's group lacks or has besides is moved into the star, so differences are each set's own. Two sets of a group then
   link exactly if 100 * lost + percent * gained of both, less (100 + percent) for each difference they share, is within
   (100 - percent) * size of the star. Pairs that are without sharing any are counted by a running sum, never made; only
   sets with large differences meet others, through the lists of the differences. Pairs of different groups come from the
   index as in 4. So every set has its exact number of links, and groups of near copies take about linear work.

Links between classes are exact; a class stands for all its copies, which count as links of one another. Null and empty texts have no n-grams and link with
nothing, nor do rows with a null key; their component is their own key. Repeated rows are copies. N-grams are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatplan.llm import common
from seatplan.llm.components import components
from seatplan.llm.words import LOWER, Block, Lookup, U, blocks, hashes, mix, packed, tallied, unpacked, windows, words

#: Bits of a hash that the count keeps, and of the bitmap of hashes that occur twice (16 MB).
KEPT_BITS, MAP_BITS = 40, 27
#: Hashes that a task holds at once (32 MB).
RUN = 1 << 22
#: Hashes of a run that leave at a time, or those of one range.
SENT = 1 << 18


@dataclass(frozen=True)
class Settings:
    size: int = 5
    percent: int = 80
    frequent: int = 1 << 19
    frequent_from: int = 8
    #: Pairs of one pivot that a task checks.
    salt_rows: int = 2_000
    #: Stars that a component gets, one after another; what links with none of them is met through the index alone.
    stars: int = 2
    #: Differences that a block of far sets holds, and a quarter of those of a block of the sets they meet.
    block_differences: int = 1 << 18


def sets(block: Block, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    low = Block(LOWER[block.data], block.offsets, block.first)
    found = words(low)
    h = hashes(low.data, found.starts, found.ends)
    grams, n = windows(h, found.counts, size)
    ends = np.cumsum(n)
    for row in range(block.rows):
        count = found.counts[row]
        if n[row]:
            yield np.unique(grams[ends[row] - n[row] : ends[row]])
        elif count:
            at, out = found.first[row], np.zeros(1, dtype=np.uint64)
            for j in range(count):
                out = out * U(0x9E3779B97F4A7C15) + h[at + j]
            yield mix(out + U(count))
        else:
            yield grams[:0]


_pack, _unpack = packed, unpacked


@dataclass(frozen=True)
class Spread:
    """What all tasks know of the corpus: which hashes occur twice (a superset), and the frequent ones."""

    twice: np.ndarray
    frequent: Lookup
    counts: np.ndarray

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """0: occurs once; 1: may occur twice; more: the count of a frequent one."""
        at = (grams >> U(64 - MAP_BITS)).astype(np.int64)
        level = ((self.twice[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64)
        place = self.frequent(grams >> U(64 - KEPT_BITS))
        hot = place >= 0
        level[hot] = self.counts[place[hot]]
        return level


def packed_run(held: np.ndarray, ranges: int, shift: int) -> pa.RecordBatch:
    """The distinct hashes of each range and how often each is there; ``held`` is sorted in place and counted range by range."""
    held.sort()
    edge = np.searchsorted(held, np.arange(ranges + 1, dtype=np.uint64) << U(shift))
    full, grams, counts = np.flatnonzero(np.diff(edge)), [], []
    for r in full:
        each, n = tallied(held[edge[r] : edge[r + 1]])
        grams.append(_pack(np.diff(each, prepend=U(0))))
        counts.append(_pack(n.astype(np.uint32)))
    return pa.record_batch([pa.array(full.astype(np.int32)), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())], names=["range", "grams", "counts"])


def packed_runs(held: np.ndarray, ranges: int, shift: int) -> Iterator[pa.RecordBatch]:
    """``packed_run`` of all hashes, some whole ranges at a time: neither the task nor what reads it holds a packed run at once."""
    held.sort()
    edge = np.searchsorted(held, np.arange(ranges + 1, dtype=np.uint64) << U(shift))
    at = np.unique(np.append(edge[np.searchsorted(edge, np.arange(0, len(held), SENT))], len(held)))
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield packed_run(held[a:b], ranges, shift)


def spread(docs: DataFrame, s: Settings) -> Spread:
    spark = docs.sparkSession
    ranges = 1 << max(6, min(14, (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()))
    shift = KEPT_BITS - ranges.bit_length() + 1

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.empty(RUN, dtype=np.uint64), 0
        for batch in batches:
            for block in blocks(batch.column("_text")):
                for one in sets(block, s.size):
                    while n + len(one) >= RUN:
                        held[n:], one = one[: RUN - n] >> U(64 - KEPT_BITS), one[RUN - n :]
                        yield from packed_runs(held, ranges, shift)
                        n = 0
                    held[n : n + len(one)] = one >> U(64 - KEPT_BITS)
                    n += len(one)
        if n:
            yield from packed_runs(held[:n], ranges, shift)

    def merge(group: pa.Table) -> pa.Table:
        grams = np.concatenate([np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in group["grams"].to_pylist()])
        each = np.concatenate([_unpack(x, np.uint32) for x in group["counts"].to_pylist()])
        grams, back = np.unique(grams, return_inverse=True)
        count = np.bincount(back, weights=each).astype(np.int64)
        start = group["range"][0].as_py()
        bits = np.zeros((1 << MAP_BITS) // ranges, dtype=np.uint8)
        at = (grams[count > 1] >> U(KEPT_BITS - MAP_BITS)).astype(np.int64) - start * len(bits)
        bits[at] = 1
        hot = count >= s.frequent_from
        return pa.table(
            {
                "range": pa.array([start], pa.int32()),
                "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                "gram": pa.array([grams[hot].astype(np.int64)], pa.list_(pa.int64())),
                "count": pa.array([count[hot]], pa.list_(pa.int64())),
            }
        )

    texts = docs.select(F.col("text").alias("_text"))
    counted = common.written(
        texts.mapInArrow(runs, "range int, grams binary, counts binary")
        .groupBy("range")
        .applyInArrow(merge, "range int, bits binary, gram array<long>, count array<long>"),
        "gram-counts",
    )
    twice = np.zeros((1 << MAP_BITS) // 8, dtype=np.uint8)
    for batch in counted.select("range", "bits").toArrow().to_batches():
        for at, bits in zip(batch.column("range").to_pylist(), batch.column("bits").to_pylist(), strict=True):
            twice[at * len(bits) : (at + 1) * len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    hot = (
        counted.select(F.explode(F.arrays_zip("gram", "count")).alias("x"))
        .select("x.gram", "x.count")
        .orderBy(F.desc("count"), "gram")
        .limit(s.frequent)
        .toArrow()
        .sort_by("gram")
    )
    return Spread(twice, Lookup(hot["gram"].to_numpy(), hot["count"].to_numpy()), hot["count"].to_numpy())


def _least(n: np.ndarray | int, percent: int):
    """The least intersection of a set of n with any partner."""
    return -(-n * percent // 100)


def signatures(docs: DataFrame, known: Spread, s: Settings, key: str = "doc_id") -> DataFrame:
    """Every row's set size, a 128-bit fingerprint of the set, and the indexed part of its prefix; the set itself where there is such a part."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, at = batch.column("_key"), 0
            for block in blocks(batch.column("_text")):
                every = list(sets(block, s.size))
                sizes = np.array([len(x) for x in every], dtype=np.int64)
                flat = np.concatenate(every)
                level = shared.value.levels(flat)
                own = np.repeat(np.arange(len(every)), sizes)
                partners = np.bincount(own[level > 0], minlength=len(every))
                first, second = [], []
                for salt, into in ((U(1), first), (U(0xD1B54A32D192ED03), second)):
                    sums = np.zeros(len(flat) + 1, dtype=np.uint64)
                    np.cumsum(mix(flat ^ salt), out=sums[1:], dtype=np.uint64)
                    ends = np.cumsum(sizes)
                    into.append((sums[ends] - sums[ends - sizes]).view(np.int64))
                grams, places, kept = [], [], []
                ends = np.cumsum(sizes)
                for i, one in enumerate(every):
                    n = len(one)
                    if not n or partners[i] < _least(n, s.percent):
                        grams.append(one[:0].view(np.int64)), places.append(np.zeros(0, dtype=np.int32)), kept.append(None)
                        continue
                    mine = level[ends[i] - n : ends[i]]
                    order = np.argsort(mine, kind="stable")[: n - _least(n, s.percent) + 1]
                    place = np.flatnonzero(mine[order] > 0)
                    grams.append(one[order[place]].view(np.int64)), places.append(place.astype(np.int32)), kept.append(one.tobytes() if len(place) else None)
                width = np.array([len(x) for x in grams])
                offsets = pa.array(np.concatenate([[0], np.cumsum(width)]).astype(np.int32))
                yield pa.record_batch(
                    [
                        keys.slice(at, block.rows),
                        pa.array(sizes),
                        pa.array(first[0]),
                        pa.array(second[0]),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(grams))),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places))),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["_key", "n", "f1", "f2", "grams", "places", "set"],
                )
                at += block.rows

    kind = docs.schema[key].dataType.simpleString()
    signed = docs.select(F.col(key).alias("_key"), F.col("text").alias("_text")).mapInArrow(
        run, f"_key {kind}, n long, f1 long, f2 long, grams array<long>, places array<int>, set binary"
    )
    signed = common.written(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")
    shared.destroy()
    return signed


def passes(s: Settings):
    """Whether two entries ``(n, place)`` of one list may link: sizes in range, and members enough from their places on."""
    need = f"cast(ceil({s.percent} * (x.n + y.n) / {100 + s.percent}.0) as long)"
    return F.expr(f"100 * x.n >= {s.percent} * y.n and x.n - x.place >= {need} and y.n - y.place >= {need}")


def pivot_pairs(index: DataFrame, s: Settings) -> DataFrame:
    """Each entry with the pivot of its list and size block, where both filters pass. Lists are streamed, however long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            gram, block, place, n, c = (batch.column(x).to_numpy() for x in ("gram", "block", "place", "n", "c"))
            if not len(gram):
                continue
            fresh = np.ones(len(gram), dtype=bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])
            fresh[0] = last is None or last[0] != gram[0] or last[1] != block[0]
            lead = np.maximum.accumulate(np.where(fresh, np.arange(len(gram)), -1))
            old = lead < 0
            pc, pn, pp = (np.where(old, 0 if last is None else last[k], v[np.maximum(lead, 0)]) for k, v in ((2, c), (3, n), (4, place)))
            need = -(-s.percent * (n + pn) // (100 + s.percent))
            ok = (pc != c) & (100 * np.minimum(n, pn) >= s.percent * np.maximum(n, pn)) & (n - place >= need) & (pn - pp >= need)
            i = len(gram) - 1
            last = (gram[i], block[i], pc[i], pn[i], pp[i])
            yield pa.record_batch([pa.array(pc[ok].astype(np.int64)), pa.array(c[ok])], names=["a", "b"])

    dealt = index.repartition("gram", "block").sortWithinPartitions("gram", "block", "place", "n", "c")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def verify(pairs: DataFrame, members: DataFrame, s: Settings, differences: bool = False) -> DataFrame:
    """The pairs ``(a, b)`` whose sets link, with ``lost`` (in a alone) and ``gained`` (in b alone) where these are wanted.

    Each a's set meets its b's in a stream; a's with many b's are salted.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / s.salt_rows).cast("int").alias("salts"))
    salted = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    left = many.join(members.withColumnRenamed("c", "a"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "set")
    right = salted.join(members.withColumnRenamed("c", "b"), "b").select("a", "salt", "b", "set")
    meeting = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    names = ["a", "b", "lost", "gained"] if differences else ["a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            linked = []
            for a, b, raw in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("set"), strict=True):
                one = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
                if b is None:
                    held = one.copy()
                    continue
                at = np.searchsorted(held, one)
                both = held[np.minimum(at, len(held) - 1)] == one
                common_n = int(both.sum())
                if 100 * common_n >= s.percent * (len(held) + len(one) - common_n):
                    if differences:
                        lost = np.ones(len(held), dtype=bool)
                        lost[at[both]] = False
                        linked.append((a, b, held[lost].view(np.int64), one[~both].view(np.int64)))
                    else:
                        linked.append((a, b))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.record_batch([pa.array([x[k] for x in linked], kinds[k]) for k in range(len(names))], names=names)

    return meeting.mapInArrow(run, ", ".join(f"{x} {kind}" for x, kind in zip(names, ("long", "long", "array<long>", "array<long>"), strict=False)))


def between(index: DataFrame, label: DataFrame, known: DataFrame, whole: DataFrame, s: Settings) -> DataFrame:
    """Links ``(a, b)`` between sets of different labels ``(c, k)`` that share a list, but for the pairs ``known``."""
    placed = index.join(label, "c", "left").withColumn("k", F.coalesce("k", "c"))
    mixed = placed.groupBy("gram").agg(F.min("k").alias("_a"), F.max("k").alias("_b")).filter("_a <> _b").select("gram")
    open_ = common.written(placed.join(mixed, "gram", "left_semi"), "open-lists")
    larger = open_.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") - 1)))
    rest = (
        open_.alias("x")
        .join(larger.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.block") == F.col("y.block")) & F.expr("x.k <> y.k and (x.n < y.n or (x.n = y.n and x.c < y.c))") & passes(s))
        .selectExpr("least(x.c, y.c) as a", "greatest(x.c, y.c) as b")
        .distinct()
        .join(known.selectExpr("least(a, b) as a", "greatest(a, b) as b"), ["a", "b"], "left_anti")
    )
    return common.written(verify(common.written(rest, "open-pairs"), whole, s), "open-links")


def groups(links: DataFrame, near: DataFrame, whole: DataFrame, s: Settings) -> DataFrame:
    """``(k, c, lost, gained)``: sets by the star ``k`` that they link with, as differences from it."""
    ends = links.selectExpr("a as c").unionByName(links.selectExpr("b as c"))
    answers = common.written(near.join(ends.groupBy("c").agg(F.count("*").alias("_n")), "c"), "answers")
    none = F.array().cast("array<long>")
    found = None
    for _ in range(s.stars):
        star = answers.groupBy("k").agg(F.max(F.struct("_n", (-F.col("c")).alias("_c"))).alias("_best")).select("k", (-F.col("_best._c")).alias("a"))
        star = common.written(star, "stars")
        pairs = common.written(answers.join(star, "k").filter("c <> a").select("a", F.col("c").alias("b")), "star-pairs")
        linked = verify(pairs, whole, s, differences=True).select(F.col("a").alias("k"), F.col("b").alias("c"), "lost", "gained")
        one = common.written(linked.unionByName(star.select(F.col("a").alias("k"), F.col("a").alias("c"), none.alias("lost"), none.alias("gained"))), "star-groups")
        found = one if found is None else found.unionByName(one)
        answers = common.written(answers.join(one.select("c"), "c", "left_anti"), "answers")
    return found


def centred(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``size`` of the star, after what more than half of its group lose or gain has been moved into it."""
    many = common.written(found.groupBy("k").agg(F.count("*").alias("_m")), "group-sizes")
    moves = []
    for side in ("lost", "gained"):
        counted = found.select("k", F.explode(side).alias("_e")).groupBy("k", "_e").agg(F.count("*").alias("_n")).join(many, "k")
        moves.append(common.written(counted.filter("2 * _n > _m").groupBy("k").agg(F.collect_list("_e").alias(f"_{side}")), "moves"))
    none = F.array().cast("array<long>")
    stars = sizes.join(many.select("k"), sizes["c"] == many["k"]).select("k", "n").join(moves[0], "k", "left").join(moves[1], "k", "left")
    stars = common.written(stars.select("k", "n", F.coalesce("_lost", none).alias("_lost"), F.coalesce("_gained", none).alias("_gained")), "moved-stars")
    moved = lambda mine, out, other, into: F.concat(F.array_except(mine, out), F.array_except(into, other))
    return found.join(stars, "k").select(
        "k", "c", (F.col("n") - F.size("_lost") + F.size("_gained")).alias("size"),
        moved("lost", "_lost", "gained", "_gained").alias("lost"), moved("gained", "_gained", "lost", "_lost").alias("gained"),
    )


def within(members: DataFrame, s: Settings) -> DataFrame:
    """``(c, more)``: the copies ``w`` of all sets of its group that a set links with; ``more`` is to be summed."""
    away = (100 * F.size("lost") + s.percent * F.size("gained")).cast("long")
    measured = members.select("k", "c", "w", F.concat("lost", "gained").alias("_own"), away.alias("u"), ((100 - s.percent) * F.col("size")).cast("long").alias("room"))
    measured = common.written(measured, "measured")
    # pairs that need no common difference: a running sum over the differences' weights
    totals = common.written(measured.groupBy("k", "u", "room").agg(F.sum("w").alias("w")), "totals")
    points = totals.select("k", F.col("u").alias("at"), F.lit(0).alias("kind"), "w", "u")
    asked = totals.select("k", (F.col("room") - F.col("u")).alias("at"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("w"), "u")
    run = Window.partitionBy("k").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = points.unionByName(asked).withColumn("_sum", F.sum("w").over(run)).filter("kind = 1").select("k", "u", "_sum")
    sure = measured.join(sums, ["k", "u"]).select("c", (F.col("_sum") - F.when(F.expr("2 * u <= room"), F.col("w")).otherwise(0)).alias("more"))
    return common.written(sure, "sure-links").unionByName(common.written(far_links(measured, s), "far-links"))


def far_links(measured: DataFrame, s: Settings) -> DataFrame:
    """``(c, more)`` of pairs that link only for the differences they share; one of the two has more than half the room.

    Sets with much of it meet all sets of their group in blocks of a bounded number of differences, through lists of the
    block's differences; a block returns sums, so no pair is ever a row.
    """
    weight = F.size("_own") + 1
    heavy = F.expr("2 * u > room")
    blocks_of = measured.groupBy("k").agg(
        F.ceil(F.sum(F.when(heavy, weight).otherwise(0)) / s.block_differences).cast("int").alias("_i"),
        F.ceil(F.sum(weight) / (4 * s.block_differences)).cast("int").alias("_j"),
    ).filter("_i > 0")
    placed = measured.join(common.written(blocks_of, "far-blocks"), "k")
    own = F.pmod(F.xxhash64("c"), F.col("_i")).cast("int"), F.pmod(F.xxhash64("c", F.lit(1)), F.col("_j")).cast("int")
    many = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    columns = ["k", "i", "j", "c", "w", "u", "room", "_own", "far"]
    left = placed.filter(heavy).withColumns({"i": own[0], "j": F.explode(many("_j")), "far": F.lit(True)}).select(*columns)
    right = placed.withColumns({"j": own[1], "i": F.explode(many("_i")), "far": F.lit(False)}).select(*columns)
    percent = 100 + s.percent

    def meet(group: pa.Table) -> pa.Table:
        far = group["far"].to_numpy()
        c, w, u = (group[x].to_numpy() for x in ("c", "w", "u"))
        room = group["room"][0].as_py()
        lists = group["_own"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        elements, owner, begin = lists.flatten().to_numpy(), np.repeat(np.arange(len(c)), sizes), np.cumsum(sizes) - sizes
        near = np.flatnonzero(~far)
        place = np.full(len(c), -1)
        place[near] = np.arange(len(near))
        mine = place[owner] >= 0
        order = np.argsort(elements[mine], kind="stable")
        listed, posted = elements[mine][order], place[owner[mine]][order]
        cn, wn, un = c[near], w[near], u[near]
        more = np.zeros(len(near), dtype=np.int64)
        keys, sums = [], []
        for h in np.flatnonzero(far):
            wanted = elements[begin[h] : begin[h] + sizes[h]]
            low, high = np.searchsorted(listed, wanted, "left"), np.searchsorted(listed, wanted, "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shared = np.bincount(posted[at], minlength=len(near))
            need = u[h] + un - room
            linked = (shared > 0) & (need > 0) & (percent * shared >= need) & ((2 * un <= room) | (c[h] < cn))
            more[linked] += w[h]
            keys.append(c[h])
            sums.append(int(wn[linked].sum()))
        some = np.flatnonzero(more)
        return pa.table({"c": pa.array(np.concatenate([np.array(keys, dtype=np.int64), cn[some]])), "more": pa.array(np.concatenate([np.array(sums, dtype=np.int64), more[some]]))})

    return left.unionByName(right).groupBy("k", "i", "j").applyInArrow(meet, "c long, more long")


def join(docs: DataFrame, settings: Settings | None = None, key: str = "doc_id", count_links: bool = True) -> DataFrame:
    """``key``, ``n_shingles``, ``class_id`` (least key with the same set) and ``component_id`` (least key reachable) of every row.

    ``n_links`` is the number of other rows with a key whose set links with the row's, copies included; without
    ``count_links`` it is left out, and pairs that lie in one component anyway are not checked.
    """
    s = settings or Settings()
    common.small_batches(docs.sparkSession)
    signed = signatures(docs, spread(docs, s), s, key)
    classes = common.written(
        signed.filter("n > 0 and _key is not null").groupBy("n", "f1", "f2").agg(F.min("row").alias("c"), F.min("_key").alias("class_id"), F.count("*").alias("w")), "classes"
    )
    chosen = signed.filter("set is not null").join(classes.select(F.col("c").alias("row")), "row")
    block = F.floor(F.log("n") / log(100 / s.percent)).cast("int")
    members = common.written(chosen.select(F.col("row").alias("c"), "n", "grams", "places", "set"), "members")
    index = members.select("c", "n", F.explode(F.arrays_zip("grams", "places")).alias("e")).select(
        F.col("e.grams").alias("gram"), F.col("e.places").cast("long").alias("place"), "n", "c", block.alias("block")
    )
    whole = members.select("c", "set")
    first = common.written(pivot_pairs(index, s), "pivot-pairs")
    links = common.written(verify(first, whole, s), "pivot-links")
    near = components(links).withColumnsRenamed({"id": "c", "component": "k"})
    if count_links:
        found = groups(links, near, whole, s)
        label = found.select("c", "k")
    else:
        label = near
    every = links.unionByName(between(index, label, first, whole, s))
    group = components(every).withColumnsRenamed({"id": "c", "component": "g"})
    named = common.written(classes.join(group, "c", "left").withColumn("g", F.coalesce("g", "c")), "groups")
    least = named.groupBy("g").agg(F.min("class_id").alias("component_id"))
    by_set = named.join(least, "g").select("c", "n", "f1", "f2", "class_id", "component_id")
    columns = [
        F.col("_key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("_key").isNotNull(), F.coalesce("class_id", "_key")).alias("class_id"),
        F.when(F.col("_key").isNotNull(), F.coalesce("component_id", "_key")).alias("component_id"),
    ]
    if count_links:
        own = classes.select("c", "w")
        inner = within(centred(found, members.select("c", "n")).join(own, "c"), s)
        a, b = (label.select(F.col("c").alias(x), F.col("k").alias(f"_{x}")) for x in "ab")
        outer = every.selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct().join(a, "a", "left").join(b, "b", "left")
        outer = common.written(outer.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b"), "outer-links")
        ways = outer.unionByName(outer.selectExpr("b as a", "a as b")).join(own.withColumnRenamed("c", "b"), "b").select(F.col("a").alias("c"), F.col("w").alias("more"))
        # the steps are tables of their own: one plan of them all takes the driver's memory, however few the rows
        counted = common.written(inner.unionByName(ways).groupBy("c").agg(F.sum("more").alias("_more")), "link-counts")
        by_set = by_set.join(own, "c").join(counted, "c", "left").withColumn("_links", F.col("w") - 1 + F.coalesce("_more", F.lit(0)))
        columns.append(F.when(F.col("_key").isNotNull(), F.coalesce("_links", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")).alias("n_links"))
    return signed.select("_key", "n", "f1", "f2").join(by_set, ["n", "f1", "f2"], "left").select(*columns)


def one_of_each(docs: DataFrame, settings: Settings | None = None, key: str = "doc_id") -> DataFrame:
    """The documents without the other members of their groups: the least key stays, one row of it; rows with a null key stay.

    Of several rows under that key, one of each different text stays, so that none is lost; rows are carried as they are.
    """
    found = join(docs, settings, key, count_links=False).filter(F.col(key).isNotNull())
    keys = found.groupBy(F.col(key).alias("_marked")).agg(F.max(F.col(key) == F.col("component_id")).alias("_kept"), F.count("*").alias("_rows"))
    # of most keys there is nothing to say, so texts need not move: the others are written, and Spark sees how few they are
    marked = common.written(keys.filter("not _kept or _rows > 1").select("_marked", "_kept"), "marked-keys")
    rows = docs.select(F.struct("*").alias("_doc"), F.col(key).alias("_key"), F.xxhash64("text").alias("_same"))
    several = rows.join(marked.filter("_kept"), F.col("_key") == F.col("_marked"), "left_semi").dropDuplicates(["_key", "_same"])
    return rows.join(marked, F.col("_key") == F.col("_marked"), "left_anti").unionByName(several).select("_doc.*")
