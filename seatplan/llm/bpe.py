"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A text of up to ``chunk`` characters is one piece. A longer one is cut in one walk into chunks that overlap by ``overlap``
characters and lie on different tasks. Each chunk is pre-tokenised on its own; where the starts of pre-tokens of two
neighbours agree inside their overlap, both go on alike, so the first such place is the border between their pieces.
Pieces are then encoded in parallel, and a text's ids are its pieces' ids in order. Only starts that no later text can
move count: those of pre-tokens that end in a letter or digit, ``REACH`` characters or more before the cut.
Where some border of a text has no common start (a pre-token longer than the overlap, a long run of spaces), the text's
chunks are walked in order by one task, which holds only what follows the last sure start: a piece ends at each sure start
that a chunk brings. These pieces are encoded in parallel too, and only a pre-token itself is never divided.

Null texts are empty; empty texts have no ids. Repeated rows and keys are encoded row by row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common


@dataclass(frozen=True)
class Tokenizer:
    """Where the ranks lie (on every machine) and the pattern that cuts texts into pre-tokens."""

    path: str
    pattern: str


@lru_cache(maxsize=2)
def encoding(of: Tokenizer) -> tiktoken.Encoding:
    with open(of.path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("given", pat_str=of.pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _matcher(pattern: str):
    import regex

    return regex.compile(pattern)


#: The pattern decides on a pre-token's end within so many characters after it ("'ll" needs two), white space aside.
REACH = 8


def sure_starts(text: str, pattern: str, last: bool = False) -> list[int]:
    """Starts of pre-tokens that stand whatever follows the text (``last``: nothing does)."""
    end = len(text) if last else len(text) - REACH
    return [m.start() for m in _matcher(pattern).finditer(text) if m.start() <= end and m.group()[-1].isalnum()]


@dataclass(frozen=True)
class Chunks:
    chunk: int = 1 << 15
    overlap: int = 1 << 10


#: Chunks that a task cuts off a text before it hands them on.
CUT_AT_ONCE = 64


def _ids(of: Tokenizer):
    """For an Arrow column of texts: the number of ids, the ids as decimals joined by commas, and the decoded bytes."""

    def run(texts: list[str | None]) -> tuple[list[int], list[str], list[bytes]]:
        code = encoding(of)
        rows = [code.encode_ordinary(t) if t else [] for t in texts]
        return [len(r) for r in rows], [str(r)[1:-1].replace(" ", "") for r in rows], [code.decode_bytes(r) for r in rows]

    return run


def pieces(long: DataFrame, of: Tokenizer, chunks: Chunks) -> DataFrame:
    """``(_row, _k, _piece)`` of texts ``(_row, _text)`` longer than a chunk."""
    c, o = chunks.chunk, chunks.overlap

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text"), strict=True):
                text = text.as_py()
                n = max(-(-(len(text) - o) // c), 1)  # the last chunk is longer than the overlap
                for at in range(0, n, CUT_AT_ONCE):
                    ks = range(at, min(at + CUT_AT_ONCE, n))
                    yield pa.record_batch(
                        [pa.array([row] * len(ks), pa.int64()), pa.array(ks, pa.int32()), pa.array([k == n - 1 for k in ks]), pa.array([text[k * c : k * c + c + o] for k in ks], pa.string())],
                        names=["_row", "_k", "_last", "_chunk"],
                    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, tail = [], []
            for k, last, text in zip(*(batch.column(x).to_pylist() for x in ("_k", "_last", "_chunk")), strict=True):
                at = sure_starts(text, of.pattern, last)
                head.append([k * c + x for x in at if x <= o])
                tail.append([k * c + x for x in at if x >= c])
            kind = pa.list_(pa.int64())
            yield pa.record_batch([*batch.columns, pa.array(head, kind), pa.array(tail, kind)], names=["_row", "_k", "_last", "_chunk", "_head", "_tail"])

    dealt = long.mapInArrow(cut, "_row long, _k int, _last boolean, _chunk string").repartition("_row", "_k")
    scanned = common.written(dealt.mapInArrow(scan, "_row long, _k int, _last boolean, _chunk string, _head array<long>, _tail array<long>"), "bpe-chunks")
    ahead = scanned.select("_row", (F.col("_k") - 1).alias("_k"), F.col("_head").alias("_next"))
    borders = (
        scanned.select("_row", "_k", "_tail")
        .join(ahead, ["_row", "_k"])
        .select("_row", (F.col("_k") + 1).alias("_k"), F.array_min(F.array_intersect("_tail", "_next")).alias("_from"))
    )
    broken = borders.filter("_from is null").select("_row").distinct()
    to = borders.select("_row", (F.col("_k") - 1).alias("_k"), F.col("_from").alias("_to"))
    cuts = (
        scanned.select("_row", "_k", "_chunk")
        .join(borders, ["_row", "_k"], "left")
        .join(to, ["_row", "_k"], "left")
        .join(broken, "_row", "left_anti")
        .selectExpr("_row", "_k", f"coalesce(_from, 0) - _k * {c} as _a", f"coalesce(_to - _k * {c}, length(_chunk)) as _b", "_chunk")
        .selectExpr("_row", "_k", "substring(_chunk, cast(_a + 1 as int), cast(_b - _a as int)) as _piece")
    )
    in_order = scanned.join(broken, "_row", "left_semi").select("_row", "_k", F.when(F.col("_last"), F.col("_chunk")).otherwise(F.substring("_chunk", 1, c)).alias("_own"))
    walked = in_order.repartition("_row").sortWithinPartitions("_row", "_k").mapInArrow(walk(of.pattern), "_row long, _k int, _piece string")
    return cuts.unionByName(walked.repartition("_row", "_k"))


def walk(pattern: str):
    """For chunks ``(_row, _k, _own)`` in order, without overlap: the pieces between sure starts, numbered."""

    def pieces_of(rows: Iterator[tuple[int, str]]) -> Iterator[tuple[int, int, str]]:
        row, k, held, size, due = None, 0, [], 0, 0
        for at, own in rows:
            if at != row:
                if held:
                    yield row, k, "".join(held)
                row, k, held, size, due = at, 0, [], 0, 0
            held.append(own)
            size += len(own)
            # what holds no sure start is looked through again only when it has doubled
            if size >= due:
                text = "".join(held)
                border = max(sure_starts(text, pattern), default=0)
                if border:
                    yield row, k, text[:border]
                    k, text = k + 1, text[border:]
                held, size, due = [text], len(text), 0 if border else 2 * len(text)
        if held:
            yield row, k, "".join(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (x for b in batches for x in zip(b.column("_row").to_pylist(), b.column("_own").to_pylist(), strict=True))
        for row, k, piece in pieces_of(rows):
            yield pa.record_batch([pa.array([row], pa.int64()), pa.array([k], pa.int32()), pa.array([piece], pa.string())], names=["_row", "_k", "_piece"])

    return run


def encode(docs: DataFrame, of: Tokenizer, chunks: Chunks | None = None, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` (decimals joined by commas) and ``decoded`` (bytes) of every row.

    Short and long texts take different ways and are scanned once each; only chunks of long texts move.
    """
    chunks = chunks or Chunks()
    common.small_batches(docs.sparkSession)
    run, kind = _ids(of), docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("_key"), F.coalesce("text", F.lit("")).alias("_text"))
    short = given.filter(F.length("_text") <= chunks.chunk)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, ids, raw = run(part.column("_text").to_pylist())
                yield pa.record_batch([part.column("_key"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.binary())], names=[key, "n_tokens", "ids", "decoded"])

    def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, raw = run(batch.column("_piece").to_pylist())
            yield pa.record_batch([batch.column("_row"), batch.column("_k"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.binary())], names=["_row", "_k", "_n", "_ids", "_raw"])

    long = common.written(given.filter(F.length("_text") > chunks.chunk).withColumn("_row", F.monotonically_increasing_id()), "bpe-long")
    encoded = pieces(long.select("_row", "_text"), of, chunks).mapInArrow(part_of, "_row long, _k int, _n long, _ids string, _raw binary")
    joined = encoded.groupBy("_row").agg(F.sum("_n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("_k", "_ids", "_raw"))).alias("_all"))
    # a piece without ids would leave a comma too many; pieces hold one pre-token at least
    texts = F.array_join(F.transform("_all", lambda x: x["_ids"]), ",")
    # bytes are joined as text, in one walk; the cast leaves them as they are
    raw = F.array_join(F.transform("_all", lambda x: x["_raw"].cast("string")), "").cast("binary")
    rest = long.select("_row", F.col("_key").alias(key)).join(joined, "_row").select(key, "n_tokens", texts.alias("ids"), raw.alias("decoded"))
    return short.mapInArrow(whole, f"`{key}` {kind}, n_tokens long, ids string, decoded binary").unionByName(rest)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return encoded.select(
        key, "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
