"""Forecast error and the metric table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.functions.numbers import add_or_zero, step_label, under_label
from seatplan.operators.quantiles import quantiles

# Levels counted as "actual" (the two religious levels stay out), and status bounds.
ACTUAL_LEVELS = ("sd_murid", "smp_murid")
MAPE_STEPS = ((20, "BAIK"), (30, "CUKUP"))
MAPE_ABOVE = "PERLU_PERBAIKAN"
SILHOUETTE_STEPS = ((0.5, "BAIK"), (0.25, "CUKUP"))
DAVIES_BOULDIN_STEPS = ((1.0, "BAIK"), (2.0, "CUKUP"))
WEAK = "LEMAH"
# Fixed values: (model, metric, unit, meaning) of each row of the metric table.
MAPE_ROW = ("cohort_projection", "MAPE", "persen", "< 20% = Baik | < 30% = Cukup | ≥ 30% = Perlu Perbaikan")
SILHOUETTE_ROW = ("kmeans_clustering", "Silhouette_Score", "rasio", "0.5–1.0 = Baik | 0.25–0.5 = Cukup | < 0.25 = Lemah")
DAVIES_BOULDIN_ROW = ("kmeans_clustering", "Davies_Bouldin_Index", "rasio", "< 1.0 = Baik | < 2.0 = Cukup | ≥ 2.0 = Lemah")


def actual_pupils(latest: DataFrame, key: str, levels: Sequence[str] = ACTUAL_LEVELS) -> DataFrame:
    """Pupils per district; districts with none are left out, as an error in percent needs a base."""
    total = add_or_zero(*[F.col(c) for c in levels]).cast("double").alias("actual")
    return latest.select(key, total).where(F.col("actual") > 0)


def absolute_percentage_error(projection: DataFrame, actual: DataFrame, key: str, base_year: int) -> DataFrame:
    projected = projection.where(F.col("year") == base_year).select(
        key, F.col("demand_total").cast("double").alias("projected")
    )
    error = F.abs(F.col("projected") - F.col("actual")) / F.col("actual") * 100
    return projected.join(actual, key).withColumn("ape", error)


def mean_error(detail: DataFrame, out: str = "mape") -> DataFrame:
    return detail.agg(
        F.count("*").alias("districts"), F.round(F.coalesce(F.avg("ape"), F.lit(0.0)), 2).alias(out)
    )


def error_extremes(detail: DataFrame, key: str) -> DataFrame:
    """Mean, median and both ends, the worst with its district (smallest key on a tie)."""
    least_key_at_worst = F.min_by(F.col(key), F.struct(-F.col("ape"), F.col(key)))
    median = quantiles(detail, "ape", (0.5,)).select(F.col("quantiles")[0])
    return detail.agg(
        F.avg("ape").alias("mean_ape"),
        F.max("ape").alias("max_ape"),
        least_key_at_worst.alias("max_ape_key"),
        F.min("ape").alias("min_ape"),
    ).withColumn("median_ape", median.scalar())


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed. Empty bins are listed with 0."""
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    slot = f"CASE WHEN _b.hi > _b.lo THEN least(floor((`{value}` - _b.lo) / ((_b.hi - _b.lo) / {bins})), {bins - 1}) ELSE 0 END"
    counted = (
        df.where(F.col(value).isNotNull()).select(value).withColumn("_b", bounds)
        .groupBy(F.expr(f"CAST({slot} AS INT) AS bin")).agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), bounds.alias("_b"))
    return every.join(counted, "bin", "left").selectExpr(
        "bin",
        f"_b.lo + bin * (_b.hi - _b.lo) / {bins} AS bin_from",
        f"_b.lo + (bin + 1) * (_b.hi - _b.lo) / {bins} AS bin_to",
        "coalesce(n, 0L) AS n",
    )


def mape_status(value: Column) -> Column:
    return under_label(value, MAPE_STEPS, MAPE_ABOVE)


def silhouette_status(value: Column) -> Column:
    return step_label(value, SILHOUETTE_STEPS, WEAK, strict=tuple(b for b, _ in SILHOUETTE_STEPS))


def davies_bouldin_status(value: Column) -> Column:
    return under_label(value, DAVIES_BOULDIN_STEPS, WEAK)


def metric_row(df: DataFrame, value: str, row: tuple[str, str, str, str], status: Callable[[Column], Column]) -> DataFrame:
    """One row of the metric table from a one-row aggregate."""
    model, metric, unit, meaning = row
    v = F.col(value).cast("double")
    return df.select(
        F.lit(model).alias("model"), F.lit(metric).alias("metric"), v.alias("value"), F.lit(unit).alias("unit"),
        status(v).alias("status"), F.lit(meaning).alias("meaning"),
    )


def metric_table(
    mape: DataFrame | None = None, silhouette: DataFrame | None = None, davies_bouldin: DataFrame | None = None
) -> DataFrame:
    given = (
        (mape, "mape", MAPE_ROW, mape_status),
        (silhouette, "silhouette", SILHOUETTE_ROW, silhouette_status),
        (davies_bouldin, "davies_bouldin", DAVIES_BOULDIN_ROW, davies_bouldin_status),
    )
    return reduce(DataFrame.unionByName, [metric_row(df, *how) for df, *how in given if df is not None])
