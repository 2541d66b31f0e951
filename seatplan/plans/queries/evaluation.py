"""Forecast error."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.operators import evaluation as ev
from seatplan.plans.catalog import query
from seatplan.plans.standins import KEY, ape_detail, sql, sql_round, table

MAPE = f"SELECT count(*) AS districts, {sql_round('coalesce(avg(ape), 0e0)', 2)} AS mape FROM ape"


@query("mape", sql(MAPE, "ape"))
def _(spark, sf):
    return ev.mean_error(ape_detail(spark, sf))


def rounded(df, *columns, digits: int = 6):
    """Averages depend on summation order in the last digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "ape_extremes",
    sql(
        f"""SELECT {sql_round('avg(ape)', 6)} AS mean_ape, {sql_round('median(ape)', 6)} AS median_ape, max(ape) AS max_ape,
            (SELECT district_key FROM ape ORDER BY ape DESC, district_key LIMIT 1) AS max_ape_key, min(ape) AS min_ape FROM ape""",
        "ape",
    ),
)
def _(spark, sf):
    return rounded(ev.error_extremes(ape_detail(spark, sf), KEY), "mean_ape", "median_ape")


_HISTOGRAM = """SELECT CAST(b AS INTEGER) AS bin, lo + b * (hi - lo) / 10 AS bin_from, lo + (b + 1) * (hi - lo) / 10 AS bin_to,
        count(x) AS n
    FROM (SELECT min(x) AS lo, max(x) AS hi FROM xs) CROSS JOIN (SELECT unnest(range(0, 10)) AS b)
    LEFT JOIN xs ON CASE WHEN hi > lo THEN least(floor((x - lo) / ((hi - lo) / 10)), 9) ELSE 0 END = b
    GROUP BY b, lo, hi"""


@query("ape_histogram", sql(_HISTOGRAM, "ape", xs="SELECT ape AS x FROM ape"))
def _(spark, sf):
    return ev.histogram(ape_detail(spark, sf), "ape")


@query("price_histogram", sql(_HISTOGRAM, xs="SELECT l_extendedprice AS x FROM lineitem"))
def _(spark, sf):
    return ev.histogram(table(spark, sf, "lineitem"), "l_extendedprice")


@query(
    "metric_status",
    """SELECT user_id, v, CASE WHEN v < 20 THEN 'BAIK' WHEN v < 30 THEN 'CUKUP' ELSE 'PERLU_PERBAIKAN' END AS mape_status,
        CASE WHEN v / 100 > 0.5 THEN 'BAIK' WHEN v / 100 > 0.25 THEN 'CUKUP' ELSE 'LEMAH' END AS silhouette_status,
        CASE WHEN v / 20 < 1 THEN 'BAIK' WHEN v / 20 < 2 THEN 'CUKUP' ELSE 'LEMAH' END AS davies_bouldin_status
    FROM (SELECT user_id, CAST(count(*) AS DOUBLE) AS v FROM events GROUP BY user_id)""",
)
def _(spark, sf):
    v = F.col("v")
    return (
        table(spark, sf, "events").groupBy("user_id").agg(F.count("*").cast("double").alias("v"))
        .select(
            "user_id", "v", ev.mape_status(v).alias("mape_status"),
            ev.silhouette_status(v / 100).alias("silhouette_status"),
            ev.davies_bouldin_status(v / 20).alias("davies_bouldin_status"),
        )
    )
