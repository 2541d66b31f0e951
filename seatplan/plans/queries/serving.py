"""Serving queries and versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.operators import ranking, serving
from seatplan.plans.catalog import query
from seatplan.plans.queries.clusters import METRICS_SQL, WITH_PRIORITY, evaluation_metrics, priority_clusters, priority_mart
from seatplan.plans.standins import (
    KEY,
    demand,
    gap,
    gap_by_seats,
    gap_index,
    recommendation,
    sql,
    table,
)
from seatplan.session import work_path
from seatplan.sources import versioned

DESCRIPTIONS = {
    "demand": "projected seats per district and year",
    "gap": "demand against capacity",
    "recommendation": "what to build, by priority",
    "index": "composite gap index",
}


def catalog(spark, sf):
    frames = {"demand": demand, "gap": gap, "recommendation": recommendation, "index": gap_index}

    def stamped(build):
        return lambda: build(spark, sf).withColumn("_gold_created_at", F.current_timestamp())

    return serving.Catalog(spark, {n: (DESCRIPTIONS[n], stamped(f)) for n, f in frames.items()})


_CTE = {"demand": "proj", "gap": "gap", "recommendation": "rec", "index": "idx"}


@query(
    "serve_tables",
    sql(
        "\nUNION ALL ".join(
            f"SELECT '{n}' AS table_name, '{d}' AS description, count(*) AS record_count, 4 AS total_tables FROM {_CTE[n]}"
            for n, d in DESCRIPTIONS.items()
        ),
        *_CTE.values(),
    ),
)
def _(spark, sf):
    return catalog(spark, sf).list_tables()


@query(
    "serve_page",
    sql(
        """SELECT *, (SELECT count(*) FROM proj) AS record_count FROM proj
        ORDER BY district_key, year LIMIT 20 OFFSET 40""",
        "proj",
    ),
)
def _(spark, sf):
    return catalog(spark, sf).page("demand", [F.asc(KEY), F.asc("year")], limit=20, offset=40)


@query("serve_count", sql("SELECT 'gap' AS table_name, count(*) AS count FROM gap", "gap"))
def _(spark, sf):
    return catalog(spark, sf).count("gap")


@query(
    "serve_top",
    sql(
        """SELECT priority_rank, district_key, unserved, rooms_needed, recommendation,
            (SELECT count(*) FROM rec WHERE recommendation = 'USB') AS count
        FROM rec WHERE recommendation = 'USB' ORDER BY priority_rank LIMIT 5""",
        "rec",
    ),
)
def _(spark, sf):
    best = serving.ranked(recommendation(spark, sf), "priority_rank", top=5, label="recommendation", wanted="usb", most=serving.MOST_RANKED)
    return best.select("priority_rank", KEY, "unserved", "rooms_needed", "recommendation", "count")


@query(
    "index_list",
    sql(
        """SELECT index_rank, district_key, index_score, index_category, (SELECT count(*) FROM idx WHERE index_category = 'SEDANG') AS count
        FROM idx WHERE index_category = 'SEDANG' ORDER BY index_rank LIMIT 31""",
        "idx",
    ),
)
def _(spark, sf):
    best = serving.ranked(gap_index(spark, sf), "index_rank", top=31, label="index_category", wanted="sedang", most=serving.MOST_RANKED)
    return best.select("index_rank", KEY, "index_score", "index_category", "count")


@query(
    "serve_key_trend",
    sql("SELECT year, demand_total, capacity, gap, unserved, utilization_pct FROM gaps WHERE district_key = 'NATION_7'", "gaps"),
)
def _(spark, sf):
    trend = serving.key_trend(gap_by_seats(spark, sf), KEY, "nation _7", "year")
    return trend.select("year", "demand_total", "capacity", "gap", "unserved", "utilization_pct")


@query("serve_projection_trend", sql("SELECT * FROM proj WHERE district_key = 'NATION_11'", "proj"))
def _(spark, sf):
    return serving.key_trend(demand(spark, sf), KEY, "Nation_11", "year")


@query(
    "serve_clusters",
    sql("SELECT priority_rank, priority_label, index_rank, district_key FROM pri", "idx", **WITH_PRIORITY),
)
def _(spark, sf):
    return serving.cluster_list(priority_clusters(spark, sf), "index_rank").select(
        "priority_rank", "priority_label", "index_rank", KEY
    )


@query(
    "serve_cluster_summary",
    sql(
        """SELECT priority_rank, min(priority_label) AS priority_label, string_agg(district_key, ',' ORDER BY district_key) AS members
        FROM pri WHERE priority_label = 'KRITIS' GROUP BY priority_rank""",
        "idx", **WITH_PRIORITY,
    ),
)
def _(spark, sf):
    listed = serving.cluster_summary(priority_mart(spark, sf), KEY, "kritis")
    return listed.drop("page").withColumn("members", F.array_join("members", ","))


@query("serve_metrics", METRICS_SQL)
def _(spark, sf):
    """The metric table as the read interface returns it: without its time stamp."""
    stamped = evaluation_metrics(spark, sf).withColumn("_generated_at", F.current_timestamp())
    return serving.Catalog(spark, {"metrics": ("how well the models do", stamped)}).table("metrics")


@query(
    "top_orders",
    """SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS count
    FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return ranking.top_k(orders, order, 50, where=F.col("o_orderstatus") == "F", count_as="count").drop("o_orderstatus")


# --- versions ---------------------------------------------------------------------------------


def _two_versions(spark, sf) -> str:
    """The suppliers, then an update: one nation gone, one new, one changed, one column more."""
    path = work_path(spark, "versions")
    first = table(spark, sf, "supplier").where("s_nationkey <> 0").select("s_suppkey", "s_name", "s_acctbal")
    second = table(spark, sf, "supplier").where("s_nationkey <> 1").selectExpr(
        "s_suppkey", "s_name", "CASE WHEN s_nationkey = 2 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal", "true AS refreshed"
    )
    versioned.write_version(first, path)
    versioned.write_version(second, path, "UPDATE")
    return path


@query("version_as_of", "SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey <> 0")
def _(spark, sf):
    return versioned.read_version(spark, _two_versions(spark, sf), 0)


@query(
    "version_history",
    """SELECT 1 AS version, 'UPDATE' AS operation, count(*) AS rows FROM supplier WHERE s_nationkey <> 1
    UNION ALL SELECT 0, 'WRITE', count(*) FROM supplier WHERE s_nationkey <> 0""",
)
def _(spark, sf):
    return versioned.history(spark, _two_versions(spark, sf)).drop("written_at")


@query(
    "version_diff",
    """SELECT s_suppkey, CASE s_nationkey WHEN 0 THEN 'added' WHEN 1 THEN 'removed' ELSE 'changed' END AS change
    FROM supplier WHERE s_nationkey < 3""",
)
def _(spark, sf):
    path = _two_versions(spark, sf)
    old, new = versioned.read_version(spark, path, 0), versioned.read_version(spark, path)
    return versioned.diff(old, new, ["s_suppkey"], ["s_name", "s_acctbal"])
