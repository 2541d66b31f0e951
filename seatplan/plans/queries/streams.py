"""Streaming ingest over the events table, each against its batch equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.operators.cleaning import one_per_grain
from seatplan.plans.catalog import query
from seatplan.plans.standins import table
from seatplan.session import work_path
from seatplan.streaming import topics


def _stream(spark, sf, name: str = "events"):
    """A driver table as a stream, every row of it."""
    return topics.read_growing(spark, sf, f"{name}.parquet", table(spark, sf, name).schema)


def _finish(running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


def _messages(events):
    """Events as keyed messages, one topic per event type; keyed by event, so no topic sits on one partition."""
    topic = F.concat(F.lit("sby-"), F.col("event_type"))
    return topics.to_messages(events.select("event_id", "event_type", "user_id", "value"), topic, F.col("event_id"))


def _landed(spark, stream, label: str):
    root = work_path(spark, label)
    _finish(topics.land(stream, f"{root}/data", f"{root}/checkpoint", every=None))
    return spark.read.parquet(f"{root}/data")


@query(
    "stream_route",
    """SELECT 'sby-' || event_type AS topic, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY event_type""",
)
def _(spark, sf):
    """Messages decoded, routed to one folder per topic, read back."""
    schema = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value").schema
    decoded = topics.decode(_messages(_stream(spark, sf)), schema).where(F.col(topics.MALFORMED).isNull())
    return (
        _landed(spark, decoded, "stream-route").groupBy("topic")
        .agg(
            F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


@query(
    "stream_malformed",
    """SELECT event_id % 50 = 7 AS broken, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1""",
)
def _(spark, sf):
    """Cut-off messages end in a side column, the rest is parsed."""
    schema = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value").schema
    cut = F.when(F.col("key").cast("long") % 50 == 7, F.expr("left(value, length(value) - 4)")).otherwise(F.col("value"))
    decoded = topics.decode(_messages(_stream(spark, sf)).withColumn("value", cut), schema)
    landed = _landed(spark, decoded, "stream-malformed")
    return landed.groupBy(F.col(topics.MALFORMED).isNotNull().alias("broken")).agg(
        F.count("*").alias("n"), F.countDistinct("key").alias("ids")
    )


@query("stream_json_land", "SELECT event_id, event_type, user_id, value FROM events")
def _(spark, sf):
    """Landed raw, parsed later in batch."""
    schema = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value").schema
    landed = _landed(spark, _messages(_stream(spark, sf)), "stream-land")
    return topics.decode(landed.select("value"), schema).drop(topics.MALFORMED)


@query(
    "stream_publish_json",
    """SELECT 'sby-orders' AS topic, CAST(o_orderkey AS VARCHAR) AS key,
        CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey, 'o_orderstatus', o_orderstatus) AS VARCHAR) AS value FROM orders""",
)
def _(spark, sf):
    orders = _stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    landed = _landed(spark, topics.to_messages(orders, "sby-orders", F.col("o_orderkey")), "stream-publish")
    return landed.select("topic", "key", "value")


@query("stream_dedup", "SELECT event_id, event_type, user_id FROM events")
def _(spark, sf):
    """A full re-publish: each event arrives three times and is kept once."""
    events = _stream(spark, sf).select(
        F.col("event_type").alias("topic"), "event_id", "event_type", "user_id", F.current_timestamp().alias("arrived")
    )
    thrice = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("copy")
    kept = topics.drop_republished(thrice, ["event_id"], "arrived")
    return _landed(spark, kept, "stream-dedup").select("event_id", "event_type", "user_id")


@query("stream_republish", "SELECT event_id, event_type, user_id, event_id % 3 AS landed_batch FROM events")
def _(spark, sf):
    """Three publishes, each of all rows known by then, in triggers of their own: a row lands with the first that holds it."""
    root = work_path(spark, "stream-republish")
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    for upto in range(3):
        events.where(F.col("event_id") % 3 <= upto).write.mode("append").parquet(f"{root}/published")
        stream = topics.read_growing(spark, f"{root}/published", "*.parquet", events.schema)
        _finish(topics.land_new(stream, f"{root}/landed", f"{root}/checkpoint", ["event_id"], every=None))
    return spark.read.parquet(f"{root}/landed").withColumn(topics.LANDED_BATCH, F.col(topics.LANDED_BATCH).cast("long"))


@query("stream_dedup_batch", "SELECT event_id, event_type, user_id FROM events")
def _(spark, sf):
    """The batch de-duplication that catches copies from beyond the stream's memory."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return one_per_grain(twice, ["event_id"], ["copy"]).drop("copy")


@query("stream_topic_counts", "SELECT 'sby-' || event_type AS topic, count(*) AS messages FROM events GROUP BY event_type")
def _(spark, sf):
    return topics.topic_counts(_landed(spark, _messages(_stream(spark, sf)), "stream-counts"))
