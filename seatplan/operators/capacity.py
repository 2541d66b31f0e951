"""Registered and proven capacity, the gap to demand, and what to build."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatplan.functions.numbers import add_or_zero, or_zero, units_needed
from seatplan.operators.cleaning import drop_blank_keys
from seatplan.operators.ranking import rank_mart
from seatplan.operators.snapshots import fold_by_key, latest_year_only

PUPILS_PER_ROOM = 32
LEVELS = ("sd_murid", "smp_murid", "mi_murid", "mts_murid")


def registry_totals(
    registry: DataFrame,
    key: str,
    year: str,
    totals: Mapping[str, str],
    *,
    name: str | None = None,
    schools_as: str = "schools",
    keep_blank_keys: bool = False,
) -> DataFrame:
    """Sums per district over the registry's latest year; ``totals`` maps output to source column."""
    rows = latest_year_only(registry, year).where(F.col(key).isNotNull())
    if not keep_blank_keys:
        rows = drop_blank_keys(rows, key)
    sums = {out: F.expr(f"CAST(coalesce(sum(`{source}`), 0) AS BIGINT)") for out, source in totals.items()}
    return fold_by_key(
        rows, key, name, sums | {schools_as: F.count("*")}, {"registry_year": F.expr(f"CAST(max(`{year}`) AS INT)")}
    )


def pupils_served(latest: DataFrame, key: str, levels: Sequence[str] = LEVELS, out: str = "pupils") -> DataFrame:
    return latest.select(key, add_or_zero(*[F.col(c) for c in levels]).cast("long").alias(out))


def capacity_floor(registry: DataFrame, pupils: DataFrame, key: str) -> DataFrame:
    """Capacity is at least what is served today: the greater of seats and pupils."""
    joined = registry.join(pupils, key, "left").withColumn("pupils", or_zero(F.col("pupils")).cast("long"))
    return joined.withColumns(
        {
            "capacity": F.greatest("seats", "pupils").cast("long"),
            "capacity_source": F.when(F.col("seats") >= F.col("pupils"), "seats").otherwise("pupils"),
        }
    )


def demand_gap(projection: DataFrame, capacity: DataFrame, key: str) -> DataFrame:
    """Projected demand against capacity. Both sides are district marts; AQE picks the join."""
    carried = [c for c in ("seats", "pupils", "rooms", "schools") if c in capacity.columns]
    known = capacity.select(key, F.col("capacity").alias("_capacity"), *carried, F.lit(True).alias("_known"))
    return projection.join(known, key, "left").selectExpr(
        *projection.columns,
        "CAST(coalesce(_capacity, 0) AS BIGINT) AS capacity",
        *carried,
        "coalesce(_known, false) AS capacity_known",
        "demand_total - coalesce(_capacity, 0) AS gap",
        "greatest(demand_total - coalesce(_capacity, 0), 0L) AS unserved",
        "CASE WHEN _capacity > 0 THEN round(demand_total / _capacity * 100, 1) END AS utilization_pct",
    )


def recommend(
    gap: DataFrame,
    key: str,
    target_year: int,
    *,
    pupils_per_room: int = PUPILS_PER_ROOM,
    ranker: Callable[..., DataFrame] = rank_mart,
) -> DataFrame:
    """Enough, a new school, or new classrooms, ranked by unserved pupils.

    A shortage at least as large as the district's average school asks for a
    school. A district without known schools has average 0 and so always does.
    The default ranker is for one row per district; pass ``global_rank`` when
    the "districts" are fact-sized.
    """
    average = F.when(F.col("schools") > 0, F.col("capacity") / F.col("schools")).otherwise(F.lit(0.0))
    decided = gap.where(F.col("year") == target_year).withColumns(
        {
            "rooms_needed": units_needed(F.col("unserved"), pupils_per_room),
            "recommendation": F.when(F.col("unserved") <= 0, "CUKUP")
            .when(F.col("unserved") >= average, "USB")
            .otherwise("RKB"),
            "priority_score": F.col("unserved").cast("long"),
        }
    )
    return ranker(decided, [F.desc("priority_score"), F.asc(key)], "priority_rank")
