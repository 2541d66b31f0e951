"""What the operators share: folds of row ids, bounded labelled samples, written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share. A session that names none (tests on one machine) gets it from its caller."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return root.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage is cut, and a lost executor loses none of it."""
    path = f"{shared_root(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds what travels to Python at once by bytes, for the session's plans from now on; a session that sets its own bound keeps it.

    By rows alone a batch has no bound: 10,000 long texts are gigabytes, held by the executor and by Python.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")


def checked(df: DataFrame, most: int) -> DataFrame:
    """The frame, to be broadcast if it has at most ``most`` rows; a larger one is joined as Spark sees fit."""
    return F.broadcast(df) if len(df.limit(most + 1).select(F.lit(1)).collect()) <= most else df


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int, key: str = "doc_id") -> DataFrame:
    """At most ``most`` labelled texts ``(_key, _order, _text, _label)``, those with the least hash of their key.

    The bound is taken on the narrow label table; what it leaves (``most`` rows of three numbers) is broadcast, so no text
    moves to be chosen. Rows with a null key or label, and keys whose
    labels disagree, teach nothing.
    """
    chosen = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & keep)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).alias("_label"), F.max(label).alias("_other"))
        .filter("_label = _other")
        .select("_key", F.xxhash64("_key").alias("_order"), F.col("_label").cast("int").alias("_label"))
        .orderBy("_order", "_key")
        .limit(most)
    )
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(chosen), "_key")
