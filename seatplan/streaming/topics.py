"""Topics in, landing files out, and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seatplan.operators.cleaning import one_per_grain

# Topic pattern of the datasets and the flush interval.
TOPIC_PATTERN = "sby-.*"
FLUSH_EVERY = "300 seconds"
MALFORMED = "_malformed"
# Which trigger landed a row.
LANDED_BATCH = "landed_batch"


def read_topics(spark: SparkSession, servers: str, pattern: str = TOPIC_PATTERN) -> DataFrame:
    """All matching topics from the earliest offset, as text (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", "earliest")
        .load()
        .select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    )


def decode(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON values to columns. A value that does not parse stays as text in ``_malformed``."""
    full = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    parsed = F.from_json(value, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    return messages.withColumn("_v", parsed).select(*[c for c in messages.columns if c != value], "_v.*")


def to_messages(df: DataFrame, topic: str | Column, key: str | Column) -> DataFrame:
    """Rows as keyed JSON messages. Key by entity: a constant key puts a dataset on one partition."""
    as_column = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(
        as_column(topic).alias("topic"), as_column(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"),
    )


def land(
    stream: DataFrame, path: str, checkpoint: str, *, by: Sequence[str] = ("topic",), every: str | None = FLUSH_EVERY,
) -> StreamingQuery:
    """Files per topic, exactly once across restarts; ``every=None`` takes what is there and ends.

    One query routes all topics. A trigger without rows writes no file.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def publish_topics(messages: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_republished(stream: DataFrame, grain: Sequence[str], arrived: str, within: str = "2 hours") -> DataFrame:
    """Rows of a periodic full re-publish only once while the period lasts.

    ``arrived`` is the time of arrival, which never runs late, so the watermark
    discards state but no rows. Copies that come after ``within`` are left to
    ``land_new`` or to the batch de-duplication on the grain.
    """
    return stream.withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(grain))


def land_new(
    stream: DataFrame, path: str, checkpoint: str, grain: Sequence[str], order: Sequence[str] = (), *, every: str | None = FLUSH_EVERY,
) -> StreamingQuery:
    """Lands a row only if no earlier trigger landed its grain, however long ago; within a trigger the last by ``order`` stays.

    Each trigger has a folder of its own, which a repeated trigger replaces, so a restart neither loses nor doubles rows. What
    landed before is read by its grain alone. A path belongs to one checkpoint. Equal null keys are one grain.
    """
    columns, grain = stream.columns, list(grain)
    landed_as = T.StructType([*stream.schema.fields, T.StructField(LANDED_BATCH, T.LongType())])

    def add(batch: DataFrame, number: int) -> None:
        fresh = one_per_grain(batch, grain, list(order), keep="last")
        if number > 0:
            before = batch.sparkSession.read.schema(landed_as).parquet(path).where(F.col(LANDED_BATCH) < number).select(*grain)
            known = before.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(grain)])
            same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(grain)]
            fresh = fresh.join(known, reduce(lambda a, b: a & b, same), "left_anti")
        fresh.select(*[F.col(f"`{c}`") for c in columns]).write.mode("overwrite").parquet(f"{path}/{LANDED_BATCH}={number}")

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def topic_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count("*").alias("messages"))


def read_growing(spark: SparkSession, folder: str, pattern: str, schema: T.StructType) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
