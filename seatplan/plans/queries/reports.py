"""Report aggregates over the marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.operators import index, ranking, reports
from seatplan.plans.catalog import query
from seatplan.plans.queries.evaluation import rounded
from seatplan.plans.standins import (
    BASE_YEAR,
    HORIZON,
    KEY,
    TARGET_YEAR,
    capacity,
    demand,
    gap,
    gap_by_seats,
    gap_index,
    seats_only,
    recommendation,
    sql,
    sql_round,
    table,
)

YEARS = [BASE_YEAR + k for k in range(HORIZON + 1)]
DEMANDS = ("demand_sd", "demand_smp", "demand_total")
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in DEMANDS)


@query(
    "city_totals_growth",
    sql(
        f"SELECT *, (demand_total - base) / base * 100 AS growth_pct FROM t CROSS JOIN "
        f"(SELECT demand_total AS base FROM t WHERE year = {BASE_YEAR})".replace("SELECT *", "SELECT year, " + ", ".join(DEMANDS)),
        "proj",
        t=f"SELECT year, {_SUMS} FROM proj GROUP BY year",
    ),
)
def _(spark, sf):
    totals = reports.totals_by(demand(spark, sf), "year", DEMANDS)
    return reports.growth_from_base(totals, "year", BASE_YEAR, "demand_total")


@query(
    "projection_pivot",
    sql(
        "SELECT district_key, "
        + ", ".join(f"CAST(sum(demand_total) FILTER (year = {y}) AS BIGINT) AS y{y}" for y in YEARS)
        + " FROM proj GROUP BY district_key",
        "proj",
    ),
)
def _(spark, sf):
    wide = reports.pivot_years(demand(spark, sf), [KEY], "year", YEARS, F.sum("demand_total"), "y")
    return wide.orderBy(F.desc(f"y{TARGET_YEAR}"), KEY)


@query(
    "util_pivot",
    sql(
        "SELECT district_key, " + ", ".join(f"avg(utilization_pct) FILTER (year = {y}) AS y{y}" for y in YEARS)
        + " FROM gaps GROUP BY district_key",
        "gaps",
    ),
)
def _(spark, sf):
    wide = reports.pivot_years(gap_by_seats(spark, sf), [KEY], "year", YEARS, F.avg("utilization_pct"), "y")
    return wide.orderBy(F.col(f"y{TARGET_YEAR}").desc_nulls_last(), KEY)


@query("deficit_by_year", sql("SELECT year, CAST(sum(unserved) AS BIGINT) AS unserved FROM gaps GROUP BY year", "gaps"))
def _(spark, sf):
    return reports.totals_by(gap_by_seats(spark, sf), "year", ["unserved"])


@query(
    "kpi_row",
    sql(
        f"""SELECT *, total_demand / total_capacity * 100 AS global_utilization_pct FROM (
            SELECT CAST(sum(demand_total) AS BIGINT) AS total_demand, CAST(sum(unserved) AS BIGINT) AS total_unserved,
                count(*) FILTER (utilization_pct > 100) AS districts_over, count(*) AS districts,
                (SELECT CAST(sum(capacity) AS BIGINT) FROM seatcap) AS total_capacity
            FROM gaps WHERE year = {TARGET_YEAR})""",
        "gaps", "seatcap",
    ),
)
def _(spark, sf):
    return reports.kpi_row(gap_by_seats(spark, sf), seats_only(spark, sf), TARGET_YEAR)


@query("recommendation_mix", sql("SELECT recommendation, count(*) AS n FROM rec GROUP BY recommendation", "rec"))
def _(spark, sf):
    return reports.frequency(recommendation(spark, sf), "recommendation")


@query(
    "index_category",
    sql(
        """SELECT index_category, count(*) AS n,
            CAST(list_position(['KRITIS', 'TINGGI', 'SEDANG', 'RENDAH', 'AMAN'], index_category) AS INTEGER) AS position
        FROM idx GROUP BY index_category""",
        "idx",
    ),
)
def _(spark, sf):
    return reports.frequency(gap_index(spark, sf), "index_category", index.CATEGORY_ORDER).orderBy("position")


@query(
    "index_stats",
    sql(
        f"""SELECT index_category, count(*) AS n, {sql_round('avg(index_score)', 2)} AS mean_score,
            min(index_score) AS min_score, max(index_score) AS max_score FROM idx GROUP BY index_category""",
        "idx",
    ),
)
def _(spark, sf):
    return reports.category_stats(gap_index(spark, sf), "index_category", "index_score")


@query(
    "index_share",
    sql(
        """SELECT index_category, count(*) AS n, count(*) / (SELECT count(*) FROM idx) * 100 AS share_pct
        FROM idx GROUP BY index_category""",
        "idx",
    ),
)
def _(spark, sf):
    return reports.frequency_share(gap_index(spark, sf), "index_category")


@query(
    "index_mean_median",
    sql(f"SELECT {sql_round('avg(index_score)', 6)} AS mean_value, {sql_round('median(index_score)', 6)} AS median_value FROM idx", "idx"),
)
def _(spark, sf):
    return rounded(reports.mean_and_median(gap_index(spark, sf), "index_score"), "mean_value", "median_value")


def _quartiles_sql(by: str, value: str, source: str) -> str:
    parts = ", ".join(f"{sql_round(f'quantile_cont({value}, {q})', 6)} AS q{i}" for i, q in ((1, 0.25), (2, 0.5), (3, 0.75)))
    return f"SELECT {by}, min({value}) AS low, {parts}, max({value}) AS high FROM {source} GROUP BY {by}"


@query("util_quartiles", sql(_quartiles_sql("year", "utilization_pct", "gaps"), "gaps"))
def _(spark, sf):
    return rounded(reports.quartiles(gap_by_seats(spark, sf), "year", "utilization_pct"), "q1", "q2", "q3")


@query("quantity_quartiles", _quartiles_sql("l_returnflag", "l_quantity", "lineitem"))
def _(spark, sf):
    return rounded(reports.quartiles(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity"), "q1", "q2", "q3")


@query("quantity_quartiles_sketch")
def _(spark, sf):
    """The form for measures with too many distinct values to count exactly."""
    return reports.quartiles(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", approximate=True)


@query(
    "share_of_max",
    sql(
        """SELECT year, demand_sd, demand_sd / (SELECT max(demand_sd) FROM t) * 100 AS bar_pct FROM t""",
        "proj",
        t="SELECT year, CAST(sum(demand_sd) AS BIGINT) AS demand_sd FROM proj GROUP BY year",
    ),
)
def _(spark, sf):
    return ranking.share_of_max(reports.totals_by(demand(spark, sf), "year", ["demand_sd"]), "demand_sd", "bar_pct")


@query(
    "top_demand_vs_base",
    sql(
        f"""SELECT t.district_key, t.demand_total, b.demand_total AS demand_base
        FROM (SELECT * FROM proj WHERE year = {TARGET_YEAR} ORDER BY demand_total DESC, district_key LIMIT 10) t
        LEFT JOIN (SELECT * FROM proj WHERE year = {BASE_YEAR}) b USING (district_key)""",
        "proj",
    ),
)
def _(spark, sf):
    every = demand(spark, sf)
    target = every.where(F.col("year") == TARGET_YEAR).select(KEY, "demand_total")
    top = ranking.top_k(target, [F.desc("demand_total"), F.asc(KEY)], 10)
    return reports.against_base(top, every, KEY, BASE_YEAR)


@query(
    "top_deficit",
    sql(f"SELECT district_key, unserved FROM gaps WHERE year = {TARGET_YEAR} ORDER BY unserved DESC, district_key LIMIT 10", "gaps"),
)
def _(spark, sf):
    target = gap_by_seats(spark, sf).where(F.col("year") == TARGET_YEAR).select(KEY, "unserved")
    return ranking.top_k(target, [F.desc("unserved"), F.asc(KEY)], 10)


@query("deficit_list", sql(f"SELECT district_key, unserved FROM gaps WHERE year = {TARGET_YEAR} AND unserved > 0", "gaps"))
def _(spark, sf):
    short = gap_by_seats(spark, sf).where((F.col("year") == TARGET_YEAR) & (F.col("unserved") > 0))
    return short.select(KEY, "unserved").orderBy(F.desc("unserved"), KEY)


@query("sorted_index", sql("SELECT district_key, index_score, index_rank AS position FROM idx", "idx"))
def _(spark, sf):
    rows = gap_index(spark, sf).select(KEY, "index_score")
    return ranking.rank_mart(rows, [F.desc("index_score"), F.asc(KEY)], "position").orderBy("position")


@query(
    "capacity_with_utilization",
    sql(
        f"""SELECT c.district_key, c.schools, c.capacity, c.pupils, g.utilization_pct FROM cap c
        LEFT JOIN (SELECT * FROM gap WHERE year = {TARGET_YEAR}) g USING (district_key)""",
        "cap", "gap",
    ),
)
def _(spark, sf):
    audited = capacity(spark, sf).select(KEY, "schools", "capacity", "pupils")
    return reports.capacity_with_utilization(audited, gap(spark, sf), KEY, TARGET_YEAR)
