"""Clusters, their priority and their quality."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from seatplan.operators import clusters as cl
from seatplan.operators import evaluation as ev
from seatplan.plans.catalog import query
from seatplan.plans.queries.evaluation import MAPE, rounded
from seatplan.plans.standins import KEY, NAME, ape_detail, gap_index, sql, sql_round, table
from seatplan.session import work_path
from seatplan.sources import readers, writers

# Reference points for the checks that need the same clusters on both sides.
CENTROIDS = ((0.45, 0.9, 0.1, 0.55), (0.2, 0.65, 0.05, 0.3), (0.05, 0.5, 0.3, 0.25), (0.0, 0.3, 0.0, 0.1))


def settled(spark, df, name: str):
    """A mart written as a table and read back, for work that passes over it many times."""
    root = work_path(spark, name)
    writers.overwrite_table(df, root, name)
    return readers.read_table(spark, root, name)


def index_mart(spark, sf):
    return settled(spark, gap_index(spark, sf), "index")


@query(
    "minmax_scale",
    sql(
        "SELECT district_key, "
        + ", ".join(
            f"CASE WHEN hi_{c} > lo_{c} THEN ({c} - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0.5e0 END AS {c}_scaled" for c in cl.FEATURES
        )
        + " FROM idx CROSS JOIN (SELECT "
        + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in cl.FEATURES)
        + " FROM idx)",
        "idx",
    ),
)
def _(spark, sf):
    scaled = cl.minmax_columns(index_mart(spark, sf), cl.FEATURES)
    return scaled.select(KEY, *[f"{c}_scaled" for c in cl.FEATURES])


def fixed_clusters(spark, sf):
    """Districts at their nearest given centroid, with priority."""
    index = cl.fill_missing(index_mart(spark, sf))
    near = cl.nearest_fixed([F.col(c) for c in cl.FEATURES], CENTROIDS)
    return index.withColumn("cluster_id", near)


def _distance_sql(c) -> str:
    return " + ".join(f"({f} - {v}e0) * ({f} - {v}e0)" for f, v in zip(cl.FEATURES, c, strict=True))


_FIXED = "SELECT *, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS cluster_id FROM (SELECT *, [" + ", ".join(
    _distance_sql(c) for c in CENTROIDS
) + "] AS ds FROM idx)"
_LEVEL = "(" + " + ".join(f"avg({f})" for f in cl.FEATURES) + ") / 4"
_PRIORITY = f"""SELECT f.*, priority_rank, ['KRITIS', 'TINGGI', 'SEDANG', 'RENDAH'][priority_rank] AS priority_label
    FROM fixed f JOIN (SELECT cluster_id, CAST(row_number() OVER (ORDER BY {_LEVEL} DESC, cluster_id) AS INTEGER) AS priority_rank
        FROM fixed GROUP BY cluster_id) USING (cluster_id)"""
WITH_PRIORITY = {"fixed": _FIXED, "pri": _PRIORITY}


@query("assign_nearest_centroid", sql("SELECT district_key, cluster_id FROM fixed", "idx", fixed=_FIXED))
def _(spark, sf):
    return fixed_clusters(spark, sf).select(KEY, "cluster_id")


def priority_clusters(spark, sf):
    return cl.with_priority(fixed_clusters(spark, sf), "cluster_id", known=len(CENTROIDS))


def priority_mart(spark, sf):
    return settled(spark, priority_clusters(spark, sf), "priority")


MART_COLUMNS = (
    KEY, NAME, "index_score", "index_category", "index_rank", "demand_base", "demand_target", "capacity",
    "deficit_rate", "utilization_norm", "growth_rate", "index_raw", "utilization_target", "deficit_target",
    "cluster_id", "priority_rank", "priority_label",
)


@query("priority_labels", sql(f"SELECT {', '.join(MART_COLUMNS)} FROM pri", "idx", **WITH_PRIORITY))
def _(spark, sf):
    return priority_clusters(spark, sf).select(*MART_COLUMNS)


@query(
    "cluster_profile",
    sql(
        "SELECT priority_rank, " + ", ".join(f"{sql_round(f'avg({f})', 6)} AS mean_{f}" for f in cl.FEATURES) + " FROM pri GROUP BY priority_rank",
        "idx", **WITH_PRIORITY,
    ),
)
def _(spark, sf):
    return rounded(cl.cluster_profile(priority_clusters(spark, sf)), *[f"mean_{f}" for f in cl.FEATURES])


@query(
    "cluster_counts",
    sql(
        f"""SELECT priority_rank, count(*) AS districts, {sql_round('avg(index_score)', 6)} AS mean_score,
            min(priority_label) AS priority_label FROM pri GROUP BY priority_rank""",
        "idx", **WITH_PRIORITY,
    ),
)
def _(spark, sf):
    return rounded(cl.cluster_counts(priority_clusters(spark, sf), "index_score"), "mean_score")


PAGE = 4


@query(
    "cluster_members",
    sql(
        """SELECT priority_rank, min(priority_label) AS priority_label, string_agg(district_key, ',' ORDER BY district_key) AS members
        FROM pri GROUP BY priority_rank""",
        "idx", **WITH_PRIORITY,
    ),
)
def _(spark, sf):
    listed = cl.cluster_members(priority_mart(spark, sf), KEY)
    return listed.drop("page").withColumn("members", F.array_join("members", ","))


@query(
    "cluster_member_pages",
    sql(
        f"""SELECT priority_rank, CAST((n - 1) // {PAGE} + 1 AS INTEGER) AS page, min(priority_label) AS priority_label,
        string_agg(district_key, ',' ORDER BY district_key) AS members
        FROM (SELECT *, row_number() OVER (PARTITION BY priority_rank ORDER BY district_key) AS n FROM pri) GROUP BY 1, 2""",
        "idx", **WITH_PRIORITY,
    ),
)
def _(spark, sf):
    """Member lists in pages of a few names."""
    listed = cl.cluster_members(priority_mart(spark, sf), KEY, PAGE)
    return listed.withColumn("members", F.array_join("members", ","))


# --- quality by label over the embeddings ----------------------------------------------------

_POINTS = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"
_DIMS = "SELECT vec_id, label, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM points"
_CENTERS = "SELECT label, list(m ORDER BY i) AS c, any_value(n) AS n FROM (SELECT label, i, avg(v) AS m, count(*) AS n FROM dims GROUP BY label, i) GROUP BY label"
_SHAPE = "SELECT label, any_value(c) AS c, avg(list_distance(x, c)) AS s FROM points JOIN centers USING (label) GROUP BY label"
_DB = f"""SELECT {sql_round('avg(worst)', 4)} AS davies_bouldin FROM (
    SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM shape a JOIN shape b ON a.label <> b.label GROUP BY a.label)"""
_EMBED = {"points": _POINTS, "dims": _DIMS, "centers": _CENTERS}


@query("davies_bouldin_by_label", sql(_DB, **_EMBED, shape=_SHAPE))
def _(spark, sf):
    return cl.davies_bouldin(table(spark, sf, "embeddings"), "embedding", "label", alone=None)


# pairwise on purpose: the SQL side takes the definition, the Spark side the closed form
_SIL = """SELECT vec_id, label, CASE WHEN n <= 1 OR b IS NULL OR greatest(a, b) <= 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END AS s FROM (
    SELECT vec_id, label, max(n) FILTER (other = label) AS n,
        max(total / nullif(n - 1, 0)) FILTER (other = label) AS a, min(total / n) FILTER (other <> label) AS b
    FROM (SELECT p.vec_id, p.label, q.label AS other, count(*) AS n, sum(pow({d}(p.x, q.x), {power})) AS total
        FROM points p CROSS JOIN points q GROUP BY ALL) GROUP BY vec_id, label)"""


@query(
    "silhouette_per_row",
    sql(f"SELECT vec_id, label, {sql_round('s', 6)} AS silhouette FROM s", points=_POINTS, s=_SIL.format(d="list_distance", power=2)),
)
def _(spark, sf):
    rows = cl.silhouette_rows(table(spark, sf, "embeddings"), "embedding", "label")
    return rounded(rows.select("vec_id", "label", "silhouette"), "silhouette")


@query(
    "silhouette_by_label",
    sql(f"SELECT {sql_round('avg(s)', 6)} AS silhouette FROM s", points=_POINTS, s=_SIL.format(d="list_distance", power=2)),
)
def _(spark, sf):
    return rounded(cl.silhouette_score(table(spark, sf, "embeddings"), "embedding", "label"), "silhouette")


@query(
    "silhouette_euclidean_districts",
    sql(
        f"SELECT vec_id AS district_key, {sql_round('s', 6)} AS silhouette FROM s",
        "idx", **WITH_PRIORITY,
        points=f"SELECT district_key AS vec_id, priority_rank AS label, [{', '.join(cl.FEATURES)}] AS x FROM pri",
        s=_SIL.format(d="list_distance", power=1),
    ),
)
def _(spark, sf):
    rows = priority_mart(spark, sf).select(KEY, "priority_rank", F.array(*cl.FEATURES).alias("x"))
    return rounded(cl.silhouette_euclidean_rows(rows, "x", "priority_rank").select(KEY, "silhouette"), "silhouette")


# --- fitted models: iterative, so rows only ---------------------------------------------------


@query("kmeans_priority")
def _(spark, sf):
    return cl.cluster_districts(index_mart(spark, sf), KEY).drop("features", "cluster_id")


def _scaled(spark, sf):
    return cl.scale_vector(cl.assemble(cl.steady_order(index_mart(spark, sf), KEY))).select("features")


@query("elbow_sweep")
def _(spark, sf):
    return cl.elbow_sweep(_scaled(spark, sf))


@query("k_quality_sweep")
def _(spark, sf):
    return cl.elbow_sweep(_scaled(spark, sf), quality=True)


@query("pca_2d")
def _(spark, sf):
    rows, shares = cl.pca_plane(index_mart(spark, sf))
    return rows.select(KEY, "pc1", "pc2", F.lit(shares[0]).alias("share_1"), F.lit(shares[1]).alias("share_2"))


@query("kmeans_embeddings")
def _(spark, sf):
    """The same fit over a fact-sized input: cluster sizes of the embedding vectors."""
    rows = table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    fitted = cl.fit_kmeans(cl.steady_order(rows, "vec_id"), 10, max_iter=50)
    return fitted.transform(rows).groupBy(F.col("prediction").alias("cluster_id")).agg(F.count("*").alias("n"))


METRICS_SQL = sql(
    f"""SELECT model, metric, value, unit, CASE metric
            WHEN 'MAPE' THEN CASE WHEN value < 20 THEN 'BAIK' WHEN value < 30 THEN 'CUKUP' ELSE 'PERLU_PERBAIKAN' END
            WHEN 'Silhouette_Score' THEN CASE WHEN value > 0.5 THEN 'BAIK' WHEN value > 0.25 THEN 'CUKUP' ELSE 'LEMAH' END
            ELSE CASE WHEN value < 1 THEN 'BAIK' WHEN value < 2 THEN 'CUKUP' ELSE 'LEMAH' END END AS status
    FROM (SELECT 'cohort_projection' AS model, 'MAPE' AS metric, mape AS value, 'persen' AS unit FROM ({MAPE})
        UNION ALL SELECT 'kmeans_clustering', 'Silhouette_Score', {sql_round('avg(s)', 4)}, 'rasio' FROM sil
        UNION ALL SELECT 'kmeans_clustering', 'Davies_Bouldin_Index', davies_bouldin, 'rasio' FROM ({_DB}))""",
    "ape", "idx", **WITH_PRIORITY,
    points=f"SELECT district_key AS vec_id, priority_rank AS label, [{', '.join(cl.FEATURES)}] AS x FROM pri",
    dims=_DIMS, centers=_CENTERS, shape=_SHAPE, sil=_SIL.format(d="list_distance", power=2),
)


@query("evaluation_metrics", METRICS_SQL)
def evaluation_metrics(spark, sf):
    rows = priority_mart(spark, sf).select("priority_rank", F.array(*cl.FEATURES).alias("x"))
    return ev.metric_table(
        ev.mean_error(ape_detail(spark, sf)),
        cl.silhouette_score(rows, "x", "priority_rank", known=len(CENTROIDS)).withColumn("silhouette", F.round("silhouette", 4)),
        cl.davies_bouldin(rows, "x", "priority_rank", known=len(CENTROIDS), alone=None),
    ).drop("meaning")
