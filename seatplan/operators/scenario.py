"""What-if scenarios over a base table of districts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.functions.numbers import clip, units_needed, whole_number
from seatplan.functions.text import contains_text

# Index weights, pupils per teacher that count as full, index limits.
WEIGHTS = {"deficit": 0.50, "teachers": 0.20, "accreditation": 0.15, "public": 0.15}
FULL_TEACHER_RATIO = 25
INDEX_LIMITS = (0.01, 0.99)
# Tier bounds (unserved must exceed, index must reach), most urgent first.
TIERS = ((2000, 0.70, "Sangat Kritis"), (600, 0.45, "Kritis"), (100, 0.35, "Waspada"))
LOWEST_TIER = "Aman"
CRITICAL_TIERS = ("Sangat Kritis", "Kritis")
# Seats of a school, of a room, shortage that justifies a school; price in billions.
SCHOOL_SEATS, ROOM_SEATS, SCHOOL_FROM = 360, 32, 300
SCHOOL_PRICE, ROOM_PRICE = 12.0, 0.35
# Gap that saturates the map shade; hue span from red to green.
SHADE_FULL_GAP, HUE_SPAN = 2500, 120
EVERYWHERE = "Semua"
NO_REGION = "–"


def scenarios(df: DataFrame, grid: Sequence[tuple[float, float, int]]) -> DataFrame:
    """Every district under every (growth %, retention %, years); an ``inline`` of a literal grid."""
    rows = [
        F.struct(
            F.lit(i).alias("scenario"), F.lit(float(g)).alias("growth_pct"),
            F.lit(float(r)).alias("retention_pct"), F.lit(int(h)).alias("years"),
        )
        for i, (g, r, h) in enumerate(grid, start=1)
    ]
    return df.select("*", F.inline(F.array(*rows)))


def project(df: DataFrame, base: str, capacity: str) -> DataFrame:
    growth = F.pow(F.lit(1.0) + F.col("growth_pct") / 100, F.col("years"))
    survival = F.pow(F.col("retention_pct") / 100, F.col("years"))
    gap = F.col(capacity) - F.col("projected_demand")
    return df.withColumn("projected_demand", whole_number(F.col(base) * growth * survival)).withColumns(
        {"capacity_gap": gap, "unserved": F.greatest(-gap, F.lit(0))}
    )


def scenario_index(df: DataFrame, capacity: str, teacher_ratio: str, accredited_pct: str, public_pct: str) -> DataFrame:
    deficit = F.greatest(
        F.lit(0.0), (F.col("projected_demand") - F.col(capacity)) / F.greatest(F.col(capacity), F.lit(1))
    )
    teachers = F.least(F.col(teacher_ratio) / FULL_TEACHER_RATIO, F.lit(1.0))
    raw = (
        deficit * WEIGHTS["deficit"]
        + teachers * WEIGHTS["teachers"]
        + (100 - F.col(accredited_pct)) / 100 * WEIGHTS["accreditation"]
        + (100 - F.col(public_pct)) / 100 * WEIGHTS["public"]
    )
    return df.withColumn("scenario_index", clip(raw, *INDEX_LIMITS))


def tier(unserved: Column, index: Column) -> Column:
    label = None
    for people, score, text in TIERS:
        hit = (unserved > people) | (index >= score)
        label = F.when(hit, text) if label is None else label.when(hit, text)
    return label.otherwise(LOWEST_TIER)


def with_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("tier", tier(F.col("unserved"), F.col("scenario_index")))


def build_need(df: DataFrame, *, exact: bool = False) -> DataFrame:
    """Schools and rooms for the unserved.

    The dashboard rounds schools up and still adds rooms for the remainder;
    ``exact`` rounds schools down so that nobody is seated twice.
    """
    u = F.col("unserved")
    large = u > SCHOOL_FROM
    schools = F.floor(u / SCHOOL_SEATS).cast("int") if exact else units_needed(u, SCHOOL_SEATS)
    return df.withColumns(
        {
            "schools_needed": F.when(large, schools).otherwise(F.lit(0)),
            "rooms_needed": F.when(large, units_needed(u % SCHOOL_SEATS, ROOM_SEATS))
            .when(u > 0, units_needed(u, ROOM_SEATS))
            .otherwise(F.lit(0)),
        }
    )


def budget(schools: Column, rooms: Column) -> Column:
    return schools * F.lit(SCHOOL_PRICE) + rooms * F.lit(ROOM_PRICE)


def totals(df: DataFrame, capacity: str, by: str = "scenario") -> DataFrame:
    return df.groupBy(by).agg(
        F.sum(capacity).alias("total_capacity"),
        F.sum("projected_demand").alias("total_demand"),
        F.sum("unserved").alias("total_unserved"),
        F.sum("schools_needed").alias("total_schools"),
        F.sum("rooms_needed").alias("total_rooms"),
        F.count_if(F.col("tier").isin(*CRITICAL_TIERS)).alias("critical_districts"),
        F.avg("scenario_index").alias("mean_index"),
    )


def map_shade(df: DataFrame) -> DataFrame:
    """Signed intensity of the gap and hue of the index; drawing is left to the map."""
    strength = F.least(F.abs(F.col("capacity_gap")) / SHADE_FULL_GAP, F.lit(1.0))
    return df.withColumns(
        {
            "shade": F.when(F.col("capacity_gap") < 0, -strength).otherwise(strength),
            "hue": (F.lit(1.0) - F.col("scenario_index")) * HUE_SPAN,
        }
    )


def search(df: DataFrame, name: str, region: str, text: str = "", in_region: str = EVERYWHERE) -> DataFrame:
    rows = df.where(contains_text(F.col(name), text))
    return rows if in_region == EVERYWHERE else rows.where(F.col(region) == in_region)


def with_region(df: DataFrame, regions: DataFrame, key: str, region: str) -> DataFrame:
    """Region of each district, or a dash."""
    return df.join(regions.select(key, region), key, "left").withColumn(region, F.coalesce(region, F.lit(NO_REGION)))
