"""Latest snapshots, projection, capacity, gap, recommendation, index."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.operators import capacity as cap
from seatplan.operators import index, projection, ranking, reports
from seatplan.operators.snapshots import latest_marts, latest_per_key
from seatplan.plans.catalog import query
from seatplan.plans.standins import (
    KEY,
    NAME,
    PERIOD,
    age_vector,
    ape_detail,
    capacity,
    demand,
    gap,
    gap_by_seats,
    gap_index,
    keyed,
    latest_pupils,
    nations,
    pupil_fact,
    recommendation,
    registry_totals,
    sql,
    table,
)

FACT_COLUMNS = (KEY, NAME, PERIOD, "tahun", *cap.LEVELS)


@query("latest_snapshot", sql(f"SELECT {', '.join(FACT_COLUMNS)} FROM latest", "latest"))
def _(spark, sf):
    return latest_pupils(spark, sf).select(*FACT_COLUMNS)


@query(
    "latest_marts",
    sql(
        """SELECT 'pupils' AS mart, district_key, period_norm, tahun, sd_murid + smp_murid AS amount FROM latest
        UNION ALL SELECT 'religious', district_key, period_norm, tahun, mi_murid + mts_murid FROM latest""",
        "latest",
    ),
)
def _(spark, sf):
    fact = pupil_fact(spark, sf)
    measures = {"pupils": ("sd_murid", "smp_murid"), "religious": ("mi_murid", "mts_murid")}
    tables = {m: fact.select(KEY, PERIOD, "tahun", (F.col(a) + F.col(b)).alias("amount")) for m, (a, b) in measures.items()}
    pupils, religious = (
        df.withColumn("mart", F.lit(m)) for m, df in latest_marts(tables, KEY, "tahun", PERIOD).items()
    )
    return pupils.unionByName(religious)


@query("population_by_age", sql("SELECT * FROM vec", "vec"))
def _(spark, sf):
    return age_vector(spark, sf)


_SEX_AGE = [(a, s, f"{w}_{s}") for a, w in enumerate(projection.AGE_WORDS) for s in projection.SEX_SUFFIXES]


def wide_population(spark, sf):
    """Monthly wide age rows per district and market segment (as sub-district), with NULL for no people."""
    hit = {
        c: f"count_if(o_orderkey % 16 = {a} AND o_orderkey div 16 % 2 = {projection.SEX_SUFFIXES.index(s)})" for a, s, c in _SEX_AGE
    }
    monthly = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("data_tahun"), F.month("o_orderdate").alias("data_bulan"))
        .agg(*[F.expr(f"{h} AS {c}") for c, h in hit.items()])
    )
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return (
        monthly.join(customer, "o_custkey")
        .groupBy("c_nationkey", F.col("c_mktsegment").alias("nama_kelurahan"), "data_tahun", "data_bulan")
        .agg(*[F.expr(f"nullif(sum({c}), 0) AS {c}") for c in hit])
        .join(nations(spark, sf, "c_nationkey"), "c_nationkey")
        .withColumn("kecamatan", F.concat(F.lit("Kec. "), F.col("n_name")))
        .drop("c_nationkey", "n_name")
    )


@query(
    "population_wide_latest",
    sql(
        "SELECT district_key, min(district_name) AS district_name, "
        + ", ".join(f"CAST(count(*) FILTER (age = {a}) AS BIGINT) AS usia_{a}" for a in range(16))
        + """ FROM rows WHERE ym = newest GROUP BY district_key""",
        rows="""SELECT n_name AS district_key, n_name AS district_name, o_orderkey % 16 AS age,
            year(o_orderdate) * 12 + month(o_orderdate) AS ym,
            max(year(o_orderdate) * 12 + month(o_orderdate)) OVER (PARTITION BY n_name, c_mktsegment) AS newest
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey""",
    ),
)
def _(spark, sf):
    """One snapshot per sub-district, so that a person is not counted once per month."""
    newest = latest_per_key(
        keyed(wide_population(spark, sf)), [KEY, "nama_kelurahan"], [F.col("data_tahun"), F.col("data_bulan")]
    )
    return projection.age_vector_from_wide(newest, KEY, NAME)


@query(
    "age_unpivot",
    sql("SELECT district_key, age, CAST(sum(people) AS BIGINT) AS people FROM pop GROUP BY ALL", "pop"),
)
def _(spark, sf):
    return projection.unpivot_ages(age_vector(spark, sf), [KEY]).where("people > 0")


@query("cohort_projection", sql("SELECT * FROM proj", "proj"))
def _(spark, sf):
    return demand(spark, sf)


@query("registry_totals", sql("SELECT * FROM regtot", "regtot"))
def _(spark, sf):
    return registry_totals(spark, sf)


@query("capacity_floor", sql("SELECT * FROM cap", "cap"))
def _(spark, sf):
    return capacity(spark, sf)


@query("gap_analysis", sql("SELECT * FROM gap", "gap"))
def _(spark, sf):
    return gap(spark, sf)


@query("gap_by_registered_seats", sql("SELECT * FROM gaps", "gaps"))
def _(spark, sf):
    return gap_by_seats(spark, sf)


@query("recommend_build", sql("SELECT * FROM rec", "rec"))
def _(spark, sf):
    return recommendation(spark, sf)


@query("gap_index", sql("SELECT * FROM idx", "idx"))
def _(spark, sf):
    return gap_index(spark, sf)


@query(
    "index_contribution",
    sql(
        """SELECT index_rank, district_key, index_score, deficit_rate * 0.5e0 * 100e0 AS deficit_rate_points,
            utilization_norm * 0.3e0 * 100e0 AS utilization_norm_points, growth_rate * 0.2e0 * 100e0 AS growth_rate_points
        FROM idx ORDER BY index_rank LIMIT 15""",
        "idx",
    ),
)
def _(spark, sf):
    parts = [f"{c}_points" for c in index.WEIGHTS]
    return ranking.top_k(index.contributions(gap_index(spark, sf)), [F.asc("index_rank")], 15).select(
        "index_rank", KEY, "index_score", *parts
    )


@query("ape_detail", sql("SELECT * FROM ape", "ape"))
def _(spark, sf):
    return ape_detail(spark, sf)


@query(
    "global_rank_orders",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank
    FROM orders""",
)
def _(spark, sf):
    """A rank over every order, spread over range partitions."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.global_rank(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], "price_rank")


@query(
    "max_detail",
    """SELECT s_suppkey AS kode_sekolah, s_name AS nama_sekolah, s_acctbal AS max_kapasitas
    FROM supplier WHERE s_acctbal = (SELECT max(s_acctbal) FROM supplier)""",
)
def _(spark, sf):
    schools = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("kode_sekolah"), F.col("s_name").alias("nama_sekolah"), "s_acctbal"
    )
    return reports.at_maximum(schools, "s_acctbal", ["kode_sekolah", "nama_sekolah"], "max_kapasitas")


@query(
    "max_plus_pct",
    "SELECT max(l_quantity) AS max_kapasitas, max(l_quantity) * 1.2e0 AS max_kapasitas_plus FROM lineitem",
)
def _(spark, sf):
    return reports.maximum_plus(table(spark, sf, "lineitem"), "l_quantity", 1.2, "max_kapasitas", "max_kapasitas_plus")
