"""Exact quantiles of any number of rows: ranks over range partitions, no group gathered anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatplan.session import ensure_checkpoint_dir


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``(_part, _g, _v, _n)``: how often each value occurs per group, in range partitions by group and value.

    Copies of a value collapse before the shuffle, and a group with a third of all rows spreads over as many
    partitions as its values need. The partitions are checkpointed: range bounds are sampled anew in every run.
    A group without a value keeps a row that counts nothing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    group = F.struct(*[F.col(f"`{c}`") for c in by]) if by else F.lit(0)
    counted = df.groupBy(group.alias("_g"), F.col(f"`{value}`").alias("_v")).agg(F.count(F.col(f"`{value}`")).alias("_n"))
    return counted.repartitionByRange("_g", "_v").withColumn("_part", F.spark_partition_id()).checkpoint()


def quantiles_of(counts: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """``(_g, _total, _at)``: per group the values at the ranks around each fraction, as a map from rank to value.

    One row per partition and group says what lies before; partitions are contiguous, so there are at most as many
    such rows as partitions and groups together. Only blocks that hold a wanted rank are looked into.
    """
    blocks = counts.groupBy("_part", "_g").agg(F.sum("_n").alias("_rows"))
    in_order = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({
        "_before": F.coalesce(F.sum("_rows").over(in_order), F.lit(0)),
        "_total": F.sum("_rows").over(Window.partitionBy("_g")),
    })
    ranks = F.array_distinct(F.array(*[end(rank_at(f)).cast("long") for f in fractions for end in (F.floor, F.ceil)]))
    wanted = blocks.withColumn(
        "_wanted", F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_rows")))
    ).where(F.size("_wanted") > 0).drop("_rows", "_total")
    running = Window.partitionBy("_part", "_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.join(wanted, ["_part", "_g"]).withColumn("_end", F.col("_before") + F.sum("_n").over(running))
    held = F.filter("_wanted", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n")))
    found = (
        ends.select("_g", F.explode(held).alias("_r"), "_v")
        .groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))
    )
    return blocks.groupBy("_g").agg(F.max("_total").alias("_total")).join(found, "_g", "left")


def rank_at(fraction: float) -> Column:
    return (F.col("_total") - 1) * F.lit(float(fraction))


def interpolated(fraction: float) -> Column:
    """The quantile between its two neighbouring ranks; NULL in a group without values."""
    at = rank_at(fraction)
    low, high = F.floor(at).cast("long"), F.ceil(at).cast("long")
    below, above = (F.try_element_at("_at", r).cast("double") for r in (low, high))
    return F.when((low == high) | (below == above), below).otherwise((high - at) * below + (at - low) * above)


def quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, quantiles)``: an array with one interpolated value per fraction."""
    groups = [F.col(f"_g.`{c}`") for c in by]
    return quantiles_of(value_counts(df, value, by), fractions).select(*groups, F.array(*[interpolated(f) for f in fractions]).alias("quantiles"))
