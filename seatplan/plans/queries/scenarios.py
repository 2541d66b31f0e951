"""What-if scenarios and nearest alternatives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatplan.operators import spatial
from seatplan.operators import scenario as sc
from seatplan.plans.catalog import query
from seatplan.plans.queries.clusters import WITH_PRIORITY, priority_clusters, settled
from seatplan.plans.queries.evaluation import rounded
from seatplan.plans.standins import KEY, LOCATED_SQL, gap_index, located, regions, sql, sql_round, table
from seatplan.session import work_path
from seatplan.sources import readers

GRID = ((2.1, 96.0, 3), (0.0, 100.0, 5), (5.0, 98.0, 10), (40.0, 100.0, 8))


def base(spark, sf):
    """Districts with capacity, school-age demand and made-up service rates."""
    return gap_index(spark, sf).select(
        KEY, F.col("capacity").cast("long").alias("capacity"), F.col("demand_base").cast("long").alias("school_age"),
        (F.col("capacity") % 16 + 10).cast("int").alias("teacher_ratio"),
        (F.col("demand_target") % 60 + 40).cast("int").alias("accredited_pct"),
        (F.col("demand_base") % 70 + 30).cast("int").alias("public_pct"),
    )


_BASE = """SELECT district_key, CAST(capacity AS BIGINT) AS capacity, CAST(demand_base AS BIGINT) AS school_age,
    CAST(capacity % 16 + 10 AS INTEGER) AS teacher_ratio, CAST(demand_target % 60 + 40 AS INTEGER) AS accredited_pct,
    CAST(demand_base % 70 + 30 AS INTEGER) AS public_pct FROM idx"""
_GRID = " UNION ALL ".join(
    f"SELECT {i} AS scenario, {g}e0 AS growth_pct, {r}e0 AS retention_pct, {h} AS years" for i, (g, r, h) in enumerate(GRID, 1)
)
_PROJECTED = """SELECT *, capacity - projected_demand AS capacity_gap, greatest(projected_demand - capacity, 0) AS unserved FROM (
    SELECT *, CAST(floor(school_age * pow(1e0 + growth_pct / 100, years) * pow(retention_pct / 100, years) + 0.5e0) AS BIGINT)
        AS projected_demand FROM base CROSS JOIN grid)"""
_INDEXED = """SELECT *, least(0.99e0, greatest(0.01e0,
    greatest(0e0, (projected_demand - capacity) / greatest(capacity, 1)) * 0.5e0 + least(teacher_ratio / 25, 1e0) * 0.2e0
    + (100 - accredited_pct) / 100 * 0.15e0 + (100 - public_pct) / 100 * 0.15e0)) AS scenario_index FROM projected"""
_BUILT = """SELECT *, CASE WHEN unserved > 2000 OR scenario_index >= 0.7e0 THEN 'Sangat Kritis'
        WHEN unserved > 600 OR scenario_index >= 0.45e0 THEN 'Kritis'
        WHEN unserved > 100 OR scenario_index >= 0.35e0 THEN 'Waspada' ELSE 'Aman' END AS tier,
    CASE WHEN unserved > 300 THEN CAST(ceil(unserved / 360) AS INTEGER) ELSE 0 END AS schools_needed,
    CASE WHEN unserved > 300 THEN CAST(ceil((unserved % 360) / 32) AS INTEGER)
         WHEN unserved > 0 THEN CAST(ceil(unserved / 32) AS INTEGER) ELSE 0 END AS rooms_needed FROM indexed"""
CTES = {"base": _BASE, "grid": _GRID, "projected": _PROJECTED, "indexed": _INDEXED, "built": _BUILT}


def grid(spark, sf):
    return sc.project(sc.scenarios(base(spark, sf), GRID), "school_age", "capacity")


def indexed(spark, sf):
    return sc.scenario_index(grid(spark, sf), "capacity", "teacher_ratio", "accredited_pct", "public_pct")


def built(spark, sf):
    return sc.build_need(sc.with_tier(indexed(spark, sf)))


@query("scenario_grid", sql("SELECT scenario, district_key, projected_demand, capacity_gap, unserved FROM projected", "idx", **CTES))
def _(spark, sf):
    return grid(spark, sf).select("scenario", KEY, "projected_demand", "capacity_gap", "unserved")


@query("scenario_index", sql("SELECT scenario, district_key, scenario_index, tier FROM built", "idx", **CTES))
def _(spark, sf):
    return built(spark, sf).select("scenario", KEY, "scenario_index", "tier")


@query("scenario_build_need", sql("SELECT scenario, district_key, unserved, schools_needed, rooms_needed FROM built", "idx", **CTES))
def _(spark, sf):
    return built(spark, sf).select("scenario", KEY, "unserved", "schools_needed", "rooms_needed")


@query(
    "build_need_by_line",
    """SELECT u AS unserved, count(*) AS n, any_value(CASE WHEN u > 300 THEN CAST(u // 360 AS INTEGER) ELSE 0 END) AS schools_needed,
        any_value(CASE WHEN u > 300 THEN CAST(ceil((u % 360) / 32) AS INTEGER) WHEN u > 0 THEN CAST(ceil(u / 32) AS INTEGER) ELSE 0 END) AS rooms_needed
    FROM (SELECT CAST(floor(l_extendedprice / 50) AS BIGINT) AS u FROM lineitem) GROUP BY u""",
)
def _(spark, sf):
    """The exact form (no double seats) over every price in the fact table."""
    rows = table(spark, sf, "lineitem").select(F.floor(F.col("l_extendedprice") / 50).alias("unserved"))
    counted = rows.groupBy("unserved").agg(F.count("*").alias("n"))
    return sc.build_need(counted, exact=True)


@query(
    "scenario_budget",
    sql("SELECT scenario, district_key, schools_needed * 12e0 + rooms_needed * 0.35e0 AS budget FROM built WHERE unserved > 0", "idx", **CTES),
)
def _(spark, sf):
    rows = built(spark, sf).where("unserved > 0")
    cost = sc.budget(F.col("schools_needed"), F.col("rooms_needed"))
    return rows.select("scenario", KEY, cost.alias("budget"))


@query(
    "scenario_totals",
    sql(
        f"""SELECT *, total_schools * 12e0 + total_rooms * 0.35e0 AS total_budget FROM (
            SELECT scenario, CAST(sum(capacity) AS BIGINT) AS total_capacity, CAST(sum(projected_demand) AS BIGINT) AS total_demand,
                CAST(sum(unserved) AS BIGINT) AS total_unserved, CAST(sum(schools_needed) AS BIGINT) AS total_schools,
                CAST(sum(rooms_needed) AS BIGINT) AS total_rooms,
                count(*) FILTER (tier IN ('Sangat Kritis', 'Kritis')) AS critical_districts,
                {sql_round('avg(scenario_index)', 6)} AS mean_index FROM built GROUP BY scenario)""",
        "idx", **CTES,
    ),
)
def _(spark, sf):
    sums = rounded(sc.totals(built(spark, sf), "capacity"), "mean_index")
    return sums.withColumn("total_budget", sc.budget(F.col("total_schools"), F.col("total_rooms")))


@query(
    "map_shading",
    sql(
        """SELECT scenario, district_key, CASE WHEN capacity_gap < 0 THEN -1e0 ELSE 1e0 END * least(abs(capacity_gap) / 2500, 1e0) AS shade,
            (1e0 - scenario_index) * 120 AS hue FROM built""",
        "idx", **CTES,
    ),
)
def _(spark, sf):
    return sc.map_shade(built(spark, sf)).select("scenario", KEY, "shade", "hue")


@query(
    "region_search",
    sql(
        """SELECT i.district_key, index_score, coalesce(region, '–') AS region FROM idx i LEFT JOIN regions r USING (district_key)
        WHERE contains(lower(i.district_key), 'nation_1') AND coalesce(region, '–') = 'AMERICA'""",
        "idx", "regions",
    ),
)
def _(spark, sf):
    rows = sc.with_region(gap_index(spark, sf).select(KEY, "index_score"), regions(spark, sf), KEY, "region")
    return sc.search(rows, KEY, "region", "Nation_1", "AMERICA")


@query(
    "region_lookup",
    sql("SELECT i.district_key, coalesce(region, '–') AS region FROM idx i LEFT JOIN regions r USING (district_key)", "idx", "regions"),
)
def _(spark, sf):
    return sc.with_region(gap_index(spark, sf).select(KEY), regions(spark, sf), KEY, "region")


_LOCATED = f"SELECT *, {LOCATED_SQL} FROM built"


@query(
    "nearest_safe",
    sql(
        """SELECT scenario, district_key, safe_key, d AS distance_deg, d * 111 AS distance_km, d * 111 * 2 AS minutes FROM (
            SELECT p.scenario, p.district_key, q.district_key AS safe_key, d,
                row_number() OVER (PARTITION BY p.scenario, p.district_key ORDER BY d, q.district_key) AS rn
            FROM spots p JOIN spots q USING (scenario) CROSS JOIN LATERAL (SELECT sqrt((p.latitude - q.latitude) * (p.latitude - q.latitude)
                + (p.longitude - q.longitude) * (p.longitude - q.longitude)) AS d)
            WHERE p.tier IN ('Sangat Kritis', 'Kritis') AND q.tier = 'Aman') WHERE rn = 1""",
        "idx", **CTES, spots=_LOCATED,
    ),
)
def _(spark, sf):
    at = settled(spark, located(built(spark, sf)), "scenario")
    each = [spatial.nearest_safe(at.where(F.col("scenario") == i), KEY).withColumn("scenario", F.lit(i)) for i in range(1, len(GRID) + 1)]
    return reduce(DataFrame.unionByName, each)


def _customer_points(spark, sf):
    """Customers spread over the plane by number; balances jitter them off the lattice."""
    n = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        (F.lit(-7.35) + (n * 37 % 200) * F.lit(0.001) + F.col("c_acctbal") * F.lit(1e-7)).alias("latitude"),
        (F.lit(112.6) + (n * 53 % 260) * F.lit(0.001)).alias("longitude"),
    )


def _district_centres(spark, sf):
    return located(table(spark, sf, "nation").select(F.col("n_name").alias(KEY)))


_POINTS = """SELECT c_custkey, -7.35e0 + (c_custkey * 37 % 200) * 0.001e0 + c_acctbal * 1e-7 AS latitude,
    112.6e0 + (c_custkey * 53 % 260) * 0.001e0 AS longitude FROM customer"""
_CENTRES = f"SELECT district_key, {LOCATED_SQL} FROM (SELECT n_name AS district_key FROM nation)"


def _nearest_sql(points_id: str, sites_id: str) -> str:
    return f"""SELECT {points_id}, {sites_id}, d AS distance_deg FROM (
        SELECT p.{points_id}, q.{sites_id}, d, row_number() OVER (PARTITION BY p.{points_id} ORDER BY d, q.{sites_id}) AS rn
        FROM points p CROSS JOIN sites q CROSS JOIN LATERAL (SELECT sqrt((p.latitude - q.latitude) * (p.latitude - q.latitude)
            + (p.longitude - q.longitude) * (p.longitude - q.longitude)) AS d)) WHERE rn = 1"""


@query("nearest_centroid", sql(_nearest_sql("c_custkey", "district_key"), points=_POINTS, sites=_CENTRES))
def _(spark, sf):
    return spatial.assign_district(_customer_points(spark, sf), _district_centres(spark, sf), "c_custkey", KEY)


_SUPPLIERS = """SELECT s_suppkey, -7.35e0 + (s_suppkey * 29 % 200) * 0.001e0 AS latitude,
    112.6e0 + (s_suppkey * 31 % 260) * 0.001e0 AS longitude FROM supplier"""


@query("nearest_by_grid", sql(_nearest_sql("c_custkey", "s_suppkey"), points=_POINTS, sites=_SUPPLIERS))
def _(spark, sf):
    """Sites that grow with the data: the grid form, exact without comparing all pairs."""
    n = F.col("s_suppkey")
    sites = table(spark, sf, "supplier").select(
        "s_suppkey", (F.lit(-7.35) + (n * 29 % 200) * F.lit(0.001)).alias("latitude"),
        (F.lit(112.6) + (n * 31 % 260) * F.lit(0.001)).alias("longitude"),
    )
    return spatial.nearest_by_grid(_customer_points(spark, sf), sites, "c_custkey", "s_suppkey")


@query(
    "points_in_boundaries",
    sql(
        """SELECT s_suppkey, count(*) AS n, min(c_custkey) AS first_customer, max(c_custkey) AS last_customer
        FROM (SELECT s.s_suppkey, c.c_custkey, c.longitude AS x, c.latitude AS y, s.longitude AS a, s.latitude AS b FROM sites s, points c)
        WHERE (x >= a - 0.006e0 AND x < a + 0.006e0 AND y >= b - 0.006e0 AND y < b + 0.006e0
               AND NOT (x >= a - 0.002e0 AND x < a + 0.002e0 AND y >= b - 0.002e0 AND y < b + 0.002e0))
           OR (x >= a + 0.01e0 AND x < a + 0.013e0 AND y >= b + 0.01e0 AND y < b + 0.013e0)
        GROUP BY s_suppkey""",
        points=_POINTS, sites=_SUPPLIERS,
    ),
)
def _(spark, sf):
    """Customers within the area of each supplier: a square with a hole, and a smaller one apart, from a file of boundaries."""
    n = F.col("s_suppkey")
    lat, lon = F.lit(-7.35) + (n * 29 % 200) * F.lit(0.001), F.lit(112.6) + (n * 31 % 260) * F.lit(0.001)
    around = lambda a, b: F.array(*[
        F.array(lon + F.lit(x) if x >= 0 else lon - F.lit(-x), lat + F.lit(y) if y >= 0 else lat - F.lit(-y)) for x, y in ((a, a), (b, a), (b, b), (a, b), (a, a))
    ])
    feature = F.struct(
        F.lit("Feature").alias("type"), F.struct("s_suppkey").alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(around(-0.006, 0.006), around(-0.002, 0.002)), F.array(around(0.01, 0.013))).alias("coordinates")).alias("geometry"),
    )
    path = work_path(spark, "areas")
    table(spark, sf, "supplier").select(F.to_json(feature).alias("value")).write.text(path)
    areas = readers.read_boundaries(spark, path, one_document_per_file=False, properties="s_suppkey: long")
    measures = F.count("*").alias("n"), F.min("c_custkey").alias("first_customer"), F.max("c_custkey").alias("last_customer")
    return spatial.per_shape(_customer_points(spark, sf), areas, "c_custkey", "s_suppkey", *measures)


def _boundary_file(spark, sf) -> str:
    """A feature collection with a square around each district centre."""
    half = 0.004
    corners = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
    ring = F.array(*[F.array(F.col("longitude") + F.lit(dx), F.col("latitude") + F.lit(dy)) for dx, dy in corners])
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col(KEY).alias("kecamatan_norm"), "latitude", "longitude").alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    path = work_path(spark, "geojson")
    # one document for all districts: a boundary file is bounded by their number
    _district_centres(spark, sf).agg(F.collect_list(feature).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")
    ).write.mode("errorifexists").text(path)
    return path


@query(
    "boundary_join",
    sql(
        """SELECT p.district_key, index_score, index_category, priority_rank, true AS inside, 5 AS corners
        FROM pri p""",
        "idx", **WITH_PRIORITY,
    ),
)
def _(spark, sf):
    features = readers.read_geojson(spark, _boundary_file(spark, sf)).withColumnRenamed("kecamatan_norm", KEY)
    clustered = priority_clusters(spark, sf)
    joined = spatial.boundary_join(
        features, clustered.select(KEY, "index_score", "index_category"), clustered.select(KEY, "priority_rank"), KEY
    )
    return spatial.inside(joined).select(
        KEY, "index_score", "index_category", "priority_rank", "inside", F.size("ring").alias("corners")
    )


@query("boundaries_in_region", sql("SELECT district_key FROM regions WHERE region = 'ASIA'", "regions"))
def _(spark, sf):
    features = readers.read_geojson(spark, _boundary_file(spark, sf)).withColumnRenamed("kecamatan_norm", KEY)
    return spatial.boundaries_in_region(features, regions(spark, sf), KEY, "region", "ASIA").select(KEY)
