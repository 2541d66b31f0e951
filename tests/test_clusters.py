import math
import random

import numpy as np
import pytest
from conftest import as_dicts
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from seatplan.operators import clusters as cl
from seatplan.operators import evaluation as ev


def points(seed=3, n=60, k=4, dims=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % k, 0.6) for _ in range(dims)], i % k) for i in range(n)]
    return [*rows, (n, [9.0] * dims, 77)]  # one lonely cluster


@pytest.fixture
def labelled(frame):
    return frame(points(), "id int, x array<double>, label int")


def brute_silhouette(rows, power):
    d = lambda a, b: math.dist(a, b) ** power
    out = {}
    for i, x, c in rows:
        own = [d(x, y) for j, y, o in rows if o == c and j != i]
        if not own:
            out[i] = 0.0
            continue
        others = {o for _, _, o in rows} - {c}
        b = min(np.mean([d(x, y) for _, y, p in rows if p == o]) for o in others)
        a = np.mean(own)
        out[i] = (b - a) / max(a, b)
    return out


def test_silhouette_equals_its_definition(labelled):
    got = {r["id"]: r["silhouette"] for r in cl.silhouette_rows(labelled, "x", "label").collect()}
    assert got == pytest.approx(brute_silhouette(points(), 2), abs=1e-9)
    assert got[60] == 0.0


def test_euclidean_silhouette_equals_its_definition(labelled):
    got = {r["id"]: r["silhouette"] for r in cl.silhouette_euclidean_rows(labelled, "x", "label").collect()}
    assert got == pytest.approx(brute_silhouette(points(), 1), abs=1e-9)
    with pytest.raises(ValueError):
        cl.silhouette_euclidean_rows(labelled, "x", "label", max_rows=10)


def test_silhouette_agrees_with_the_evaluator(labelled):
    ours = cl.silhouette_score(labelled, "x", "label").first()[0]
    frame = labelled.select(array_to_vector("x").alias("features"), F.col("label").cast("double").alias("prediction"))
    assert ours == pytest.approx(ClusteringEvaluator().evaluate(frame), abs=1e-9)


def brute_db(rows):
    centers = {c: np.mean([x for _, x, o in rows if o == c], axis=0) for c in {r[2] for r in rows}}
    s = {c: np.mean([math.dist(x, m) for _, x, o in rows if o == c]) for c, m in centers.items()}
    worst = []
    for i in centers:
        ratios = [(s[i] + s[j]) / math.dist(centers[i], centers[j]) for j in centers if j != i and math.dist(centers[i], centers[j]) > 0]
        worst.append(max(ratios, default=0.0))
    return round(float(np.mean(worst)), 4)


def test_davies_bouldin(frame, labelled):
    assert cl.davies_bouldin(labelled, "x", "label").first()[0] == brute_db(points())
    same = [(1, [0.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 1.0], 2), (4, [1.0, -1.0], 2), (5, [9.0, 0.0], 3)]
    df = frame(same, "id int, x array<double>, label int")
    assert cl.davies_bouldin(df, "x", "label").first()[0] == brute_db(same)  # clusters 1 and 2 share a centroid
    given = frame([(1, [5.0, 5.0]), (2, [0.0, 9.0]), (3, [9.0, 0.0])], "label int, centroid array<double>")
    s = {1: (math.dist((0, 0), (5, 5)) + math.dist((2, 0), (5, 5))) / 2, 2: (math.dist((1, 1), (0, 9)) + math.dist((1, -1), (0, 9))) / 2, 3: 0.0}
    at = {1: (5, 5), 2: (0, 9), 3: (9, 0)}
    want = sum(max((s[i] + s[j]) / math.dist(at[i], at[j]) for j in at if j != i) for i in at) / 3
    assert cl.davies_bouldin(df, "x", "label", given).first()[0] == round(want, 4)
    alone = frame(same[:2], "id int, x array<double>, label int")
    assert cl.davies_bouldin(alone, "x", "label").first()[0] == 0.0


def test_one_cluster_is_not_called_good(frame):
    one = cl.davies_bouldin(frame([(1, [0.0, 0.0], 1), (2, [2.0, 0.0], 1)], "id int, x array<double>, label int"), "x", "label", alone=None)
    row = ev.metric_table(davies_bouldin=one).first()
    assert (row["value"], row["status"]) == (None, ev.WEAK)


def test_minmax_and_missing(frame):
    df = frame([(1, 0.0, 5.0), (2, 10.0, 5.0), (3, None, 5.0)], "id int, a double, c double")
    got = as_dicts(cl.minmax_columns(df, ["a", "c"]), "id")
    assert [(got[i]["a_scaled"], got[i]["c_scaled"]) for i in (1, 2, 3)] == [(0.0, 0.5), (1.0, 0.5), (None, 0.5)]
    assert cl.assemble(df, ["a", "c"]).count() == 2  # the NULL row is skipped
    assert cl.fill_missing(df, ["a"]).where("id = 3").first()["a"] == 0.0


def test_nearest_fixed_prefers_the_lower_index(frame):
    near = cl.nearest_fixed([F.col("a")], [(0.0,), (2.0,), (2.0,)])
    got = frame([(1.0,), (1.5,), (-3.0,)], "a double").select(near.alias("i")).collect()
    assert [r["i"] for r in got] == [0, 1, 0]


def test_priority_goes_to_the_highest_means(frame):
    rows = [("a", 7, 0.1), ("b", 7, 0.2), ("c", 3, 0.9), ("d", 5, 0.5), ("e", 9, 0.05), ("f", 11, 0.01)]
    df = frame(rows, "k string, cluster int, f double")
    got = {r["k"]: (r["priority_rank"], r["priority_label"]) for r in cl.with_priority(df, "cluster", ["f"]).collect()}
    assert got == {"c": (1, "KRITIS"), "d": (2, "TINGGI"), "a": (3, "SEDANG"), "b": (3, "SEDANG"), "e": (4, "RENDAH"), "f": (5, "RENDAH")}


def district_rows():
    rng = random.Random(5)
    centers = [(0.9, 0.9, 0.9, 0.9), (0.6, 0.6, 0.5, 0.6), (0.3, 0.3, 0.2, 0.3), (0.0, 0.1, 0.0, 0.05)]
    return [(f"D{i:02}", *[c + rng.uniform(-0.02, 0.02) for c in centers[i % 4]]) for i in range(24)]


def test_cluster_districts_finds_clear_groups(frame):
    df = frame(district_rows(), "k string, deficit_rate double, utilization_norm double, growth_rate double, index_raw double")
    got = cl.cluster_districts(df, "k").withColumn("index_score", F.col("index_raw"))
    assert {r["k"]: r["priority_rank"] for r in got.collect()} == {f"D{i:02}": i % 4 + 1 for i in range(24)}
    counts = as_dicts(cl.cluster_counts(got, "index_score"), "priority_rank")
    assert [counts[i]["districts"] for i in (1, 2, 3, 4)] == [6] * 4
    assert as_dicts(cl.cluster_members(got, "k"), "priority_rank")[2]["members"] == [f"D{i:02}" for i in range(1, 24, 4)]
    pages = {(r["priority_rank"], r["page"]): r["members"] for r in cl.cluster_members(got, "k", 4).collect()}
    assert pages[2, 1] == [f"D{i:02}" for i in range(1, 16, 4)] and pages[2, 2] == ["D17", "D21"] and len(pages) == 8
    profile = as_dicts(cl.cluster_profile(got), "priority_rank")
    assert profile[1]["mean_deficit_rate"] > profile[4]["mean_deficit_rate"]


def test_elbow_falls_with_k(frame):
    df = frame(district_rows(), "k string, deficit_rate double, utilization_norm double, growth_rate double, index_raw double")
    scaled = cl.scale_vector(cl.assemble(df)).select("features")
    rows = cl.elbow_sweep(scaled, (2, 4), quality=True).orderBy("k").collect()
    assert rows[0]["inertia"] > rows[1]["inertia"]
    assert rows[1]["silhouette"] > 0.9 and rows[1]["davies_bouldin"] < 0.2


def test_pca_matches_the_covariance(frame):
    rows = district_rows()
    df = frame(rows, "k string, deficit_rate double, utilization_norm double, growth_rate double, index_raw double")
    plane, shares = cl.pca_plane(df)
    x = np.array([r[1:] for r in rows])
    x -= x.mean(axis=0)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert shares == pytest.approx(list((s**2 / (s**2).sum())[:2]), abs=1e-9)
    got = {r["k"]: (r["pc1"], r["pc2"]) for r in plane.collect()}
    want = x @ vt[:2].T
    for (k, *_), w in zip(rows, want, strict=True):
        assert np.abs(got[k]) == pytest.approx(np.abs(w), abs=1e-9)
