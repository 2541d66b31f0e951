"""Ranks, top-k and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatplan.operators.snapshots import comparable
from seatplan.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row number below


def rank_mart(df: DataFrame, order: Sequence[Column], rank_as: str) -> DataFrame:
    """Row number over a whole mart (one row per district; already aggregated).

    The window has no partition key, so the input passes one task: right for
    marts, wrong for facts. Facts take ``global_rank``.
    """
    return df.withColumn(rank_as, F.row_number().over(Window.orderBy(*order)))


def global_rank(df: DataFrame, order: Sequence[Column], rank_as: str, *, partitions: int | None = None) -> DataFrame:
    """Row number over rows of any number, without one task seeing them all.

    Range partitions are sorted each by itself and numbered; the row counts of
    the earlier partitions (one small row per partition) are then added. The
    numbered rows are checkpointed because range bounds are sampled anew in
    every run and counting must see the very partitions that were numbered.
    ``order`` has to end in a unique column: it settles ties and lets a value
    held by many rows spread over partitions.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _LOCAL_BITS)
    local = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # one row per shuffle partition: bounded by the partition count, not by the data
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank_as, local + F.col("_before") + 1)
        .drop("_id", "_part", "_before")
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int, *, where: Column | None = None, count_as: str | None = None) -> DataFrame:
    """The first ``k`` rows, optionally with the number of rows before the cut."""
    rows = df if where is None else df.where(where)
    cut = rows.orderBy(*order).limit(k)
    if count_as is None:
        return cut
    return cut.withColumn(count_as, rows.agg(F.count("*")).scalar())


DEEP_OFFSET = 100_000


def page(df: DataFrame, order: Sequence[Column], *, limit: int = 100, offset: int = 0, deep: int = DEEP_OFFSET) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in ``order``; ties are settled by the rows' other columns.

    Near the front that is a top-k. A top-k keeps offset + limit rows in one
    place, so deep pages number the rows over range partitions instead. Both
    follow the same order, so pages on either side of ``deep`` fit together.
    """
    if not 1 <= limit <= 10_000:
        raise ValueError("limit must lie in 1..10000")
    if offset < 0:
        raise ValueError("offset must not be negative")
    order = [*order, *[F.col(f"`{f.name}`") for f in df.schema.fields if comparable(f.dataType)]]
    if offset <= deep:
        return df.orderBy(*order).offset(offset).limit(limit)
    numbered = global_rank(df, order, "_at")
    return numbered.where(F.col("_at").between(offset + 1, offset + limit)).orderBy("_at").drop("_at")


def share_of_max(df: DataFrame, value: str, out: str) -> DataFrame:
    """Value in percent of the greatest value."""
    with_top = df.withColumn("_top", df.agg(F.max(value)).scalar())
    return with_top.withColumn(out, F.when(F.col("_top") > 0, F.col(value) / F.col("_top") * 100)).drop("_top")
