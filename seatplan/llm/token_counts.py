"""Document lengths in flat token files that have no index, by their end-of-document ids.

A file is a run of ids of fixed width; it is read in blocks of any size. Each block is searched at once for the end id
(numpy), and tells its length, how many ends it has, and what lies before the first and after the last. A prefix scan over
these few numbers stitches the documents that cross blocks; no ids move.

The end id is not counted. Two ends in a row enclose an empty document. What follows the last end is a document of its own
with ``ended`` false. Empty blocks and files hold nothing. Blocks with a null file or place are refused by the reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatplan.llm import bpe, common


def read_flat(spark: SparkSession, path: str, block_bytes: int = 1 << 22) -> DataFrame:
    """``(file, block, data)`` of flat files of up to 2 GB each; ``block_bytes`` is a multiple of the id's width."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    cut = files.select(F.col("path").alias("file"), "content", F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / block_bytes).cast("int") - 1)).alias("block"))
    return cut.select("file", F.col("block").cast("long").alias("block"), F.expr(f"substring(content, block * {block_bytes} + 1, {block_bytes})").alias("data"))


def flat_blocks(docs: DataFrame, of: bpe.Tokenizer, end: int, block_ids: int = 1 << 20, key: str = "doc_id", width: str = "<u2") -> DataFrame:
    """Texts as flat token files, one for each partition: ``(file, block, data, keys)``; ``keys`` lists the texts that end in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, file, block = bpe.encoding(of), f"tokens-{TaskContext.get().partitionId():06d}", 0
        held, keys = bytearray(), []
        size = block_ids * np.dtype(width).itemsize
        mark = np.array([end], dtype=width).tobytes()

        def put(data: bytes, ended: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([file]), pa.array([block], pa.int64()), pa.array([data], pa.binary()), pa.array([ended], pa.list_(kind))], names=["file", "block", "data", "keys"])

        for batch in batches:
            column = batch.column("_key")
            kind = column.type
            for at in range(0, batch.num_rows, 256):
                texts = batch.column("_text").slice(at, 256).to_pylist()
                for k, text in zip(column.slice(at, 256).to_pylist(), texts, strict=True):
                    held += np.array(code.encode_ordinary(text) if text else [], dtype=width).tobytes() + mark
                    while len(held) > size:
                        yield put(bytes(held[:size]), keys)
                        del held[:size]
                        keys, block = [], block + 1
                    keys.append(k)
        if held:
            yield put(bytes(held), keys)

    kind = docs.schema[key].dataType.simpleString()
    common.small_batches(docs.sparkSession)
    return docs.select(F.col(key).alias("_key"), F.col("text").alias("_text")).mapInArrow(run, f"file string, block long, data binary, keys array<{kind}>")


def scan(blocks: DataFrame, end: int, width: str = "<u2") -> DataFrame:
    """``(file, doc_index, first_token, n_tokens, ended)`` of every document in blocks ``(file, block, data)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column("data"):
                ids = np.frombuffer(raw.as_buffer(), dtype=width) if raw.as_buffer() is not None else np.zeros(0, dtype=width)
                rows.append((len(ids), np.flatnonzero(ids == end)))
            yield pa.record_batch(
                [
                    batch.column("file"),
                    batch.column("block"),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([at.astype(np.int64) for _, at in rows], pa.list_(pa.int64())),
                ],
                names=["file", "block", "n", "ends"],
            )

    found = blocks.select("file", "block", "data").mapInArrow(run, "file string, block long, n long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    has = F.size("ends") > 0
    # where the open document began: behind the latest end of an earlier block
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = found.withColumn("base", base).withColumn("latest", F.when(has, F.col("base") + F.element_at("ends", -1) + 1))
    stitched = placed.withColumn("open", F.coalesce(F.max("latest").over(before), F.lit(0))).withColumn("done", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
    starts = F.concat(F.array("open"), F.transform("ends", lambda x: x + F.col("base") + 1))
    # starts go along with their ends, so no row carries a block's whole list; the last start has no end
    paired = stitched.withColumn("starts", starts).withColumn("both", F.arrays_zip("starts", "ends"))
    closed = paired.select("file", "done", "base", F.posexplode("both").alias("i", "one")).filter("one.ends is not null").select(
        "file",
        (F.col("done") + F.col("i")).alias("doc_index"),
        F.col("one.starts").alias("first_token"),
        (F.col("base") + F.col("one.ends") - F.col("one.starts")).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    last = stitched.groupBy("file").agg(F.sum("n").alias("n"), F.coalesce(F.max("latest"), F.lit(0)).alias("open"), F.sum(F.size("ends")).alias("done"))
    rest = last.filter("open < n").selectExpr("file", "done as doc_index", "open as first_token", "n - open as n_tokens", "false as ended")
    return closed.unionByName(rest)


def named(counted: DataFrame, blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds the key of each document from the writer's ``keys``, by its place in the file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    listed = blocks.select("file", "block", "keys").withColumn("done", F.coalesce(F.sum(F.size("keys")).over(before), F.lit(0)))
    keys = listed.select("file", "done", F.posexplode("keys").alias("i", key)).select("file", (F.col("done") + F.col("i")).alias("doc_index"), key)
    return counted.join(keys, ["file", "doc_index"])
