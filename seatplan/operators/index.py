"""Composite gap index and its categories."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.functions.numbers import step_label
from seatplan.operators.ranking import rank_mart

# Component weights, utilisation that counts as full, score steps.
WEIGHTS = {"deficit_rate": 0.50, "utilization_norm": 0.30, "growth_rate": 0.20}
UTILIZATION_CEILING = 200.0
CATEGORIES = ((70, "KRITIS"), (50, "TINGGI"), (30, "SEDANG"), (0, "RENDAH"))
LOWEST_CATEGORY = "AMAN"
CATEGORY_ORDER = ("KRITIS", "TINGGI", "SEDANG", "RENDAH", "AMAN")


def categorize(score: Column, steps: Sequence[tuple[float, str]] = CATEGORIES, lowest: str = LOWEST_CATEGORY) -> Column:
    """The last step must be exceeded, the others reached."""
    return step_label(score, steps, lowest, strict=(steps[-1][0],))


def index_inputs(gap: DataFrame, key: str, base_year: int, target_year: int, name: str | None = None) -> DataFrame:
    """Base and target year side by side: one aggregation of the gap mart, no self-join."""

    def in_year(column: str, year: int) -> str:
        return f"max(CASE WHEN year = {year} THEN {column} END)"

    label = [f"min(`{name}`) AS `{name}`"] if name else []
    measures = [
        *label,
        f"CAST({in_year('demand_total', base_year)} AS DOUBLE) AS demand_base",
        f"CAST({in_year('demand_total', target_year)} AS DOUBLE) AS demand_target",
        "CAST(max(capacity) AS DOUBLE) AS capacity",
        "max(schools) AS schools",
        f"coalesce({in_year('utilization_pct', target_year)}, 0D) AS utilization_target",
        f"CAST(coalesce({in_year('unserved', target_year)}, 0) AS DOUBLE) AS deficit_target",
    ]
    return (
        gap.where(f"year IN ({base_year}, {target_year}) AND capacity_known")
        .groupBy(key).agg(*[F.expr(m) for m in measures])
        .where("demand_base IS NOT NULL AND demand_target IS NOT NULL")
    )


def gap_index(
    inputs: DataFrame, key: str, *, weights=WEIGHTS, ranker: Callable[..., DataFrame] = rank_mart
) -> DataFrame:
    """Deficit, utilisation and growth rates, their weighted sum, its score and category, and the rank."""
    weighted = " + ".join(f"{w}D * {c}" for c, w in weights.items())
    scored = inputs.selectExpr(
        "*",
        "CASE WHEN demand_target > 0 THEN greatest(0D, (demand_target - capacity) / demand_target) ELSE 0D END AS deficit_rate",
        f"least(1D, utilization_target / {UTILIZATION_CEILING}D) AS utilization_norm",
        "CASE WHEN demand_base > 0 THEN least(1D, greatest(0D, (demand_target - demand_base) / demand_base)) ELSE 0D END AS growth_rate",
        f"{weighted} AS index_raw",
        "round(least(100D, index_raw * 100D), 2) AS index_score",
    )
    labelled = scored.withColumn("index_category", categorize(F.col("index_score")))
    return ranker(labelled, [F.desc("index_score"), F.asc(key)], "index_rank")


def contributions(index: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Points each component adds to the score."""
    return index.withColumns({f"{c}_points": F.col(c) * F.lit(w) * F.lit(100.0) for c, w in weights.items()})
