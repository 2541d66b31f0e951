"""Report aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.functions.numbers import ratio
from seatplan.operators.quantiles import interpolated, quantiles_of, value_counts


def at_maximum(df: DataFrame, value: str, columns: Sequence[str], max_as: str) -> DataFrame:
    """All rows that hold the greatest value."""
    top = df.agg(F.max(value)).scalar()
    return df.where(F.col(value) == top).select(*columns, F.col(value).alias(max_as))


def maximum_plus(df: DataFrame, value: str, factor: float, max_as: str, plus_as: str) -> DataFrame:
    return df.agg(F.max(value).alias(max_as)).withColumn(plus_as, F.col(max_as) * F.lit(factor))


def totals_by(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.sum(c).alias(c) for c in columns])


def growth_from_base(totals: DataFrame, year: str, base_year: int, value: str, out: str = "growth_pct") -> DataFrame:
    """Change in percent against the base year's total."""
    base = totals.where(F.col(year) == base_year).agg(F.max(value)).scalar()
    change = F.when(F.col("_base") != 0, (F.col(value) - F.col("_base")) / F.col("_base") * 100)
    return totals.withColumn("_base", base).withColumn(out, change).drop("_base")


def pivot_years(df: DataFrame, row: Sequence[str], year: str, years: Sequence[int], value: Column, prefix: str) -> DataFrame:
    """One column per year; the years are given, so no extra pass looks for them."""
    wide = df.groupBy(*row).pivot(year, list(years)).agg(value)
    return wide.select(*row, *[F.col(f"`{y}`").alias(f"{prefix}{y}") for y in years])


def kpi_row(gap: DataFrame, capacity: DataFrame, target_year: int) -> DataFrame:
    """Totals of the target year; capacity counts every audited district, demanded or not."""
    total_capacity = capacity.agg(F.sum("capacity")).scalar()
    return (
        gap.where(F.col("year") == target_year)
        .agg(
            F.sum("demand_total").alias("total_demand"),
            F.sum("unserved").alias("total_unserved"),
            F.count_if(F.col("utilization_pct") > 100).alias("districts_over"),
            F.count("*").alias("districts"),
        )
        .withColumn("total_capacity", total_capacity)  # evaluated once: the ratio below reads the column
        .withColumn("global_utilization_pct", ratio(F.col("total_demand"), F.col("total_capacity")) * 100)
    )


def frequency(df: DataFrame, column: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows per value; ``order`` fixes the position of known labels, absent labels do not appear."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    if not order:
        return counted
    return counted.withColumn("position", F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column)).cast("int"))


def frequency_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share; the total adds up the counts, whose shuffle is reused."""
    counted = frequency(df, column)
    return counted.withColumn("share_pct", F.col("n") / counted.agg(F.sum("n")).scalar() * 100)


def category_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    return df.groupBy(category).agg(
        F.count("*").alias("n"),
        F.round(F.avg(value), 2).alias("mean_score"),
        F.round(F.min(value), 2).alias("min_score"),
        F.round(F.max(value), 2).alias("max_score"),
    )


def mean_and_median(df: DataFrame, value: str) -> DataFrame:
    """Both from one pass over the rows: the counts per value say everything."""
    counts = value_counts(df, value)
    median = quantiles_of(counts, (0.5,)).select(interpolated(0.5))
    mean = F.sum(F.col("_v").cast("double") * F.col("_n")) / F.nullif(F.sum("_n"), F.lit(0))
    return counts.agg(mean.alias("mean_value")).withColumn("median_value", median.scalar())


def quartiles(df: DataFrame, by: str, value: str, *, approximate: bool = False) -> DataFrame:
    """Box-plot quartiles. Exact ones are selected by rank over range partitions; sketches take one aggregation."""
    if not approximate:
        last = F.col("_total") - 1
        return quantiles_of(value_counts(df, value, [by]), (0.0, 0.25, 0.5, 0.75, 1.0)).select(
            F.col(f"_g.`{by}`"), F.try_element_at("_at", F.lit(0).cast("long")).alias("low"),
            *[interpolated(f).alias(n) for n, f in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))],
            F.try_element_at("_at", last).alias("high"),
        )
    q = F.percentile_approx(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000))
    return df.groupBy(by).agg(q.alias("_q"), F.min(value).alias("low"), F.max(value).alias("high")).select(
        by, "low", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q2"), F.col("_q")[2].alias("q3"), "high"
    )


def against_base(top: DataFrame, demand: DataFrame, key: str, base_year: int) -> DataFrame:
    """The chosen districts with their base-year demand; absent ones stay, with NULL."""
    base = demand.where(F.col("year") == base_year).select(key, F.col("demand_total").alias("demand_base"))
    return top.join(base, key, "left")


def capacity_with_utilization(capacity: DataFrame, gap: DataFrame, key: str, target_year: int) -> DataFrame:
    used = gap.where(F.col("year") == target_year).select(key, "utilization_pct")
    return capacity.join(used, key, "left")
