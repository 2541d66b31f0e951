"""Priority clusters and their quality.

Features live in one ``array<double>`` or ML vector column. Cluster statistics
are aggregates; per-row work reads them through a scalar subquery holding one
entry per cluster, so no row pairs are ever formed between data rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatplan.operators.ranking import global_rank

FEATURES = ("deficit_rate", "utilization_norm", "growth_rate", "index_raw")
# Label of each priority, most urgent first.
PRIORITY_LABELS = ("KRITIS", "TINGGI", "SEDANG", "RENDAH")

# Every statistic below keeps one entry per cluster in one row; comparing
# clusters is quadratic in their number by definition.
MAX_CLUSTERS = 10_000
# Answers that hold all members of a mart at once: Euclidean silhouettes.
MAX_EXACT_ROWS = 20_000
MEMBERS_PER_PAGE = 1_000


def fill_missing(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return df.fillna(0.0, subset=list(columns))


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES, out: str = "features_raw") -> DataFrame:
    """Features as one vector; rows with a NULL or NaN feature are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


def scale_vector(df: DataFrame, source: str = "features_raw", out: str = "features") -> DataFrame:
    return MinMaxScaler(inputCol=source, outputCol=out).fit(df).transform(df)


def minmax_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Min-max scaling as plain columns; a constant column becomes 0.5, as the ML scaler does."""
    ends = F.struct(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))])
    scaled = [
        f"CASE WHEN `{c}` IS NOT NULL THEN CASE WHEN _b.`hi_{c}` > _b.`lo_{c}` "
        f"THEN (`{c}` - _b.`lo_{c}`) / (_b.`hi_{c}` - _b.`lo_{c}`) ELSE 0.5D END END AS `{c}{suffix}`"
        for c in columns
    ]
    return df.withColumn("_b", df.agg(ends).scalar()).selectExpr(*[f"`{c}`" for c in df.columns], *scaled)


ROWS_PER_PARTITION = 100_000


def steady_order(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash partitions, sorted inside: the seeded start of K-means depends on both.

    Their number follows from the row count, so that the same rows cluster alike
    on any cluster. Call it on a written table, where counting reads footers only.
    """
    parts = partitions or max(1, math.ceil(df.count() / ROWS_PER_PARTITION))
    return df.repartition(parts, key).sortWithinPartitions(key)


def fit_kmeans(scaled: DataFrame, k: int = 4, *, seed: int = 42, max_iter: int = 300, features: str = "features"):
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features).fit(scaled)


def elbow_sweep(scaled: DataFrame, ks: Sequence[int] = range(2, 9), *, seed: int = 42, max_iter: int = 100, quality: bool = False):
    """(k, inertia[, silhouette, davies_bouldin]) per K. Each K is its own distributed fit.

    The scaled rows are persisted for the fits; a lost executor recomputes its part.
    """
    spark = scaled.sparkSession
    kept = scaled.persist()
    out = []
    try:
        for k in ks:
            model = fit_kmeans(kept, k, seed=seed, max_iter=max_iter)
            row = (int(k), round(float(model.summary.trainingCost), 4))
            if quality:
                labelled = model.transform(kept)
                grouped = labelled.select(vector_to_array("features").alias("x"), F.col("prediction").alias("label"))
                row += (_evaluate(labelled), davies_bouldin(grouped, "x", "label", known=k, alone=None).first()["davies_bouldin"])
            out.append(row)
    finally:
        kept.unpersist()
    schema = "k int, inertia double" + (", silhouette double, davies_bouldin double" if quality else "")
    return spark.createDataFrame(out, schema)


def _evaluate(labelled: DataFrame) -> float | None:
    distinct = labelled.select("prediction").distinct().limit(2).count()
    if distinct < 2:
        return None
    return float(ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(labelled))


def nearest_fixed(columns: Sequence[Column], centroids: Sequence[Sequence[float]]) -> Column:
    """Index of the closest given centroid; the lower index wins a tie."""

    def distance(c: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for x, m in zip(columns, c, strict=True):
            total = total + (x - F.lit(float(m))) * (x - F.lit(float(m)))
        return total

    options = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centroids)]
    return F.array_min(F.array(*options))["i"]


def priority_table(clustered: DataFrame, cluster: str, columns: Sequence[str] = FEATURES, labels: Sequence[str] = PRIORITY_LABELS) -> DataFrame:
    """cluster -> (priority_rank, priority_label), highest mean of feature means first."""
    mean = sum((F.avg(c) for c in columns[1:]), F.avg(columns[0])) / len(columns)
    ranked = clustered.groupBy(cluster).agg(mean.alias("_level")).withColumn(
        "priority_rank", F.row_number().over(Window.orderBy(F.desc("_level"), F.asc(cluster)))
    )
    label = F.coalesce(F.get(F.array(*[F.lit(x) for x in labels]), F.col("priority_rank") - 1), F.lit(labels[-1]))
    return ranked.select(cluster, "priority_rank", label.alias("priority_label"))


def with_priority(
    clustered: DataFrame, cluster: str, columns: Sequence[str] = FEATURES, labels: Sequence[str] = PRIORITY_LABELS, *, known: int | None = None
) -> DataFrame:
    """Label rows by their cluster's priority; clusters without one come last.

    The priorities (one per cluster) reach the rows as one map, so rows are
    labelled where they are: no join, no shuffle on a handful of hot clusters.
    """
    _check_clusters(clustered, cluster, known)
    ranked = priority_table(clustered, cluster, columns, labels)
    found = F.try_element_at(_as_map(ranked, cluster, "priority_rank", "priority_label"), F.col(cluster))
    return clustered.withColumn("_p", found).select(
        *clustered.columns,
        F.coalesce("_p.priority_rank", F.lit(len(labels))).alias("priority_rank"),
        F.coalesce("_p.priority_label", F.lit(labels[-1])).alias("priority_label"),
    )


def _as_map(df: DataFrame, key: str, *values: str) -> Column:
    """A frame with one row per cluster as a map column; call only behind ``_check_clusters``."""
    value = F.struct(*values) if len(values) > 1 else F.col(values[0])
    return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))).scalar()


def cluster_districts(index: DataFrame, key: str, *, k: int = 4, seed: int = 42, max_iter: int = 300) -> DataFrame:
    """Assemble, scale, cluster, and label districts by priority; adds ``cluster_id`` and ``features``.

    Every pass of the fit reads the input again: give it a written mart.
    """
    scaled = scale_vector(assemble(steady_order(index, key)))
    model = fit_kmeans(scaled, k, seed=seed, max_iter=max_iter)
    labelled = model.transform(scaled).withColumnRenamed("prediction", "cluster_id").drop("features_raw")
    return with_priority(labelled, "cluster_id", known=k)


def cluster_profile(clustered: DataFrame, by: str = "priority_rank", columns: Sequence[str] = FEATURES) -> DataFrame:
    return clustered.groupBy(by).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def cluster_counts(clustered: DataFrame, score: str) -> DataFrame:
    return clustered.groupBy("priority_rank").agg(
        F.count("*").alias("districts"), F.avg(score).alias("mean_score"), F.min("priority_label").alias("priority_label")
    )


def cluster_members(clustered: DataFrame, name: str, per_page: int = MEMBERS_PER_PAGE) -> DataFrame:
    """Names per priority, all districts once each, in sorted pages numbered from 1.

    Members are numbered over range partitions, so a priority of any size never meets in one place; a page does.
    """
    rows = clustered.select("priority_rank", "priority_label", F.col(name).alias("_name"))
    numbered = global_rank(rows, [F.col("priority_rank"), F.col("_name")], "_at")
    first = numbered.groupBy(F.col("priority_rank").alias("_rank")).agg(F.min("_at").alias("_first"))
    paged = numbered.join(first, F.col("priority_rank").eqNullSafe(F.col("_rank"))).withColumn(
        "page", (F.floor((F.col("_at") - F.col("_first")) / per_page) + 1).cast("int")
    )
    return paged.groupBy("priority_rank", "page").agg(
        F.min("priority_label").alias("priority_label"), F.sort_array(F.collect_list("_name")).alias("members")
    )


# --- quality --------------------------------------------------------------------------------


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _sq_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _check_clusters(df: DataFrame, label: str, known: int | None = None) -> None:
    """``known`` is the number of clusters where the caller set it; otherwise it is looked up."""
    if known is not None and known <= MAX_CLUSTERS:
        return
    if df.select(label).distinct().limit(MAX_CLUSTERS + 1).count() > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters: these scores compare every cluster with every other")


def centroids(df: DataFrame, x: str, label: str) -> DataFrame:
    """(label, centroid, n). The vector mean is a partial aggregate; dimensions are not exploded."""
    mean = Summarizer.mean(array_to_vector(F.col(x).cast("array<double>")))
    return df.groupBy(label).agg(vector_to_array(mean).alias("centroid"), F.count("*").alias("n"))


def davies_bouldin(
    df: DataFrame, x: str, label: str, centers: DataFrame | None = None, digits: int = 4, *, known: int | None = None,
    alone: float | None = 0.0,
) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; coinciding centroids are skipped.

    With fewer than two clusters nothing is compared: the result is then ``alone``. The original's 0 is the best value there
    is, so whoever judges a clustering by the result passes None.
    ``centers`` (label, centroid) may be given; by default the clusters' own
    means. Rows look their centroid up in a map and are only aggregated, so a
    cluster with a third of all rows is no hot partition.
    """
    _check_clusters(df, label, known)
    center = (centers if centers is not None else centroids(df, x, label)).select(label, "centroid")
    own = F.try_element_at(_as_map(center, label, "centroid"), F.col(label))
    rows = df.select(F.col(label), F.col(x).cast("array<double>").alias("_x"), own.alias("_c"))
    spread = rows.groupBy(label).agg(F.avg(F.sqrt(_sq_distance(F.col("_x"), F.col("_c")))).alias("s"))
    shape = center.join(spread, label, "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
    every = shape.agg(F.collect_list(F.struct(label, "centroid", "s")).alias("all")).scalar()
    ratios = F.transform(
        "_all",
        lambda o: F.when(
            (o[label] != F.col(label)) & (_sq_distance(o["centroid"], F.col("centroid")) > 0),
            (F.col("s") + o["s"]) / F.sqrt(_sq_distance(o["centroid"], F.col("centroid"))),
        ),
    )
    worst = F.coalesce(F.array_max(ratios), F.lit(0.0))
    mean = F.when(F.count("*") > 1, F.round(F.avg(worst), digits)).otherwise(F.lit(alone).cast("double"))
    return shape.withColumn("_all", every).agg(mean.alias("davies_bouldin"))


def silhouette_rows(df: DataFrame, x: str, label: str, out: str = "silhouette", *, known: int | None = None) -> DataFrame:
    """Squared-Euclidean silhouette of every row in O(rows x clusters).

    The mean squared distance from x to a cluster is |x|^2 + mean|y|^2 - 2 x.mean(y),
    so a cluster's size, mean vector and mean squared norm say everything.
    Rows alone in their cluster score 0.
    """
    _check_clusters(df, label, known)
    rows = df.withColumn("_x", F.col(x).cast("array<double>")).withColumn("_sq", _dot(F.col("_x"), F.col("_x")))
    stats = rows.groupBy(label).agg(
        vector_to_array(Summarizer.mean(array_to_vector("_x"))).alias("mean"),
        F.avg("_sq").alias("sq"),
        F.count("*").alias("n"),
    )
    every = stats.agg(F.collect_list(F.struct(F.col(label).alias("c"), "mean", "sq", "n")).alias("all")).scalar()
    spread = F.transform(
        "_all",
        lambda o: F.struct(
            o["c"].alias("c"), o["n"].alias("n"), (F.col("_sq") + o["sq"] - 2.0 * _dot(F.col("_x"), o["mean"])).alias("d")
        ),
    )
    measured = rows.withColumn("_all", every).withColumn("_d", spread).withColumns(
        {
            "_own": F.get(F.filter("_d", lambda o: o["c"] == F.col(label)), F.lit(0)),
            "_near": F.array_min(F.transform(F.filter("_d", lambda o: o["c"] != F.col(label)), lambda o: o["d"])),
        }
    )
    n = F.col("_own")["n"]
    a = F.when(n > 1, F.col("_own")["d"] * n / (n - 1))
    b = F.col("_near")
    return measured.withColumn(out, _silhouette(n, a, b)).drop("_x", "_sq", "_all", "_d", "_own", "_near")


def _silhouette(n: Column, a: Column, b: Column) -> Column:
    larger = F.greatest(a, b)
    return F.when((n <= 1) | b.isNull() | (larger <= 0), F.lit(0.0)).otherwise((b - a) / larger)


def silhouette_score(df: DataFrame, x: str, label: str, out: str = "silhouette", *, known: int | None = None) -> DataFrame:
    return silhouette_rows(df, x, label, "_s", known=known).agg(F.avg("_s").alias(out))


def silhouette_euclidean_rows(df: DataFrame, x: str, label: str, out: str = "silhouette", max_rows: int = MAX_EXACT_ROWS) -> DataFrame:
    """Plain-Euclidean silhouette for district marts, the notebook variant.

    Needs each row's distance to every other row, so the size is checked first;
    for larger inputs use ``silhouette_rows``.
    """
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows: use the squared-Euclidean silhouette_rows")
    rows = df.withColumn("_x", F.col(x).cast("array<double>"))
    groups = rows.groupBy(label).agg(F.collect_list("_x").alias("xs"))
    every = groups.agg(F.collect_list(F.struct(F.col(label).alias("c"), "xs")).alias("all")).scalar()

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda s, y: s + F.sqrt(_sq_distance(F.col("_x"), y)))

    spread = F.transform("_all", lambda o: F.struct(o["c"].alias("c"), F.size(o["xs"]).alias("n"), total(o["xs"]).alias("t")))
    measured = rows.withColumn("_all", every).withColumn("_d", spread).withColumns(
        {
            "_own": F.get(F.filter("_d", lambda o: o["c"] == F.col(label)), F.lit(0)),
            "_near": F.array_min(F.transform(F.filter("_d", lambda o: o["c"] != F.col(label)), lambda o: o["t"] / o["n"])),
        }
    )
    n = F.col("_own")["n"]
    a = F.when(n > 1, F.col("_own")["t"] / (n - 1))
    return measured.withColumn(out, _silhouette(n, a, F.col("_near"))).drop("_x", "_all", "_d", "_own", "_near")


def pca_plane(df: DataFrame, columns: Sequence[str] = FEATURES) -> tuple[DataFrame, list[float]]:
    """Rows on the first two principal components, and the variance share of each."""
    raw = assemble(fill_missing(df, columns), columns, "_raw")
    centred = StandardScaler(withMean=True, withStd=False, inputCol="_raw", outputCol="_centred").fit(raw).transform(raw)
    model = PCA(k=2, inputCol="_centred", outputCol="_pc").fit(centred)
    xy = vector_to_array("_pc")
    return (
        model.transform(centred).withColumns({"pc1": xy[0], "pc2": xy[1]}).drop("_raw", "_centred", "_pc"),
        [float(v) for v in model.explainedVariance],
    )
