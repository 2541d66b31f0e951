import json
import math
import random

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from seatplan.functions.geo import haversine_km
from seatplan.operators import scenario as sc
from seatplan.operators import spatial
from seatplan.sources.readers import read_boundaries, read_geojson


@pytest.mark.parametrize("unserved, schools, rooms, exact_schools", [
    (0, 0, 0, 0), (1, 0, 1, 0), (300, 0, 10, 0), (301, 1, 10, 0), (360, 1, 0, 1), (361, 2, 1, 1),
])
def test_build_need(frame, unserved, schools, rooms, exact_schools):
    df = frame([(unserved,)], "unserved long")
    row = sc.build_need(df).first()
    assert (row["schools_needed"], row["rooms_needed"]) == (schools, rooms)
    assert sc.build_need(df, exact=True).first()["schools_needed"] == exact_schools


def test_projection_and_index(frame):
    df = frame([("A", 1000, 1200, 14, 80, 50)], "k string, cap int, base int, ratio int, acc int, pub int")
    grid = [(2.1, 96.0, 3), (0.0, 100.0, 5)]
    got = {r["scenario"]: r for r in as_dicts(sc.scenario_index(sc.project(sc.scenarios(df, grid), "base", "cap"), "cap", "ratio", "acc", "pub"))}
    for i, (g, r, h) in enumerate(grid, 1):
        demand = math.floor(1200 * (1 + g / 100) ** h * (r / 100) ** h + 0.5)
        assert got[i]["projected_demand"] == demand
        assert got[i]["unserved"] == max(0, demand - 1000)
        raw = max(0, (demand - 1000) / 1000) * 0.5 + 14 / 25 * 0.2 + 0.2 * 0.15 + 0.5 * 0.15
        assert got[i]["scenario_index"] == pytest.approx(min(max(raw, 0.01), 0.99))


@pytest.mark.parametrize("unserved, index, label", [
    (2001, 0.0, "Sangat Kritis"), (0, 0.70, "Sangat Kritis"), (2000, 0.1, "Kritis"), (601, 0.0, "Kritis"),
    (0, 0.45, "Kritis"), (101, 0.0, "Waspada"), (0, 0.35, "Waspada"), (100, 0.34, "Aman"),
])
def test_tiers(frame, unserved, index, label):
    assert frame([(unserved, index)], "u int, i double").select(sc.tier(F.col("u"), F.col("i")).alias("t")).first()["t"] == label


def test_totals_shade_search(frame):
    rows = [("ALPHA", 10, 20, 10, 1, 0, "Kritis", 0.5, -10), ("BETA", 5000, 20, 0, 0, 2, "Aman", 0.1, 4980)]
    df = frame(rows, "k string, cap int, projected_demand int, unserved int, schools_needed int, rooms_needed int, tier string, scenario_index double, capacity_gap int")
    t = sc.totals(df.withColumn("scenario", F.lit(1)), "cap").first()
    assert (t["total_capacity"], t["total_unserved"], t["critical_districts"]) == (5010, 10, 1)
    assert t["mean_index"] == pytest.approx(0.3)
    shade = as_dicts(sc.map_shade(df), "k")
    assert (shade["ALPHA"]["shade"], shade["BETA"]["shade"]) == (-10 / 2500, 1.0)
    assert shade["BETA"]["hue"] == pytest.approx(108)
    placed = sc.with_region(df, frame([("ALPHA", "Utara")], "k string, region string"), "k", "region")
    assert as_dicts(placed, "k")["BETA"]["region"] == "–"
    assert [r["k"] for r in sc.search(placed, "k", "region", "alp", "Utara").collect()] == ["ALPHA"]
    assert sc.search(placed, "k", "region").count() == 2


def brute_nearest(points, sites):
    out = {}
    for p, y, x in points:
        if sites:
            out[p] = min((math.sqrt((y - b) * (y - b) + (x - a) * (x - a)), s) for s, b, a in sites)[1]
    return out


def cloud(n, seed, box):
    rng = random.Random(seed)
    return [(i, rng.uniform(*box), rng.uniform(*box)) for i in range(n)]


@pytest.mark.parametrize("points, sites", [
    (cloud(200, 1, (-1, 1)), cloud(40, 2, (-1, 1))),
    (cloud(60, 3, (-80, 80)), cloud(3, 4, (0, 0.02))),              # far away from every site
    ([(0, 0.0, 0.0), (1, 5.0, 5.0)], [(9, 0.0, 1.0), (4, 0.0, -1.0), (7, 1.0, 0.0)]),  # equal distances
    (cloud(50, 5, (-1, 1)), [(i, 0.5, 0.5) for i in range(30)]),     # copies of one place
    (cloud(5, 6, (-1, 1)), []),
    ([(i, 5e6 + y * 1e4, 3e5 + x * 1e4) for i, y, x in cloud(60, 7, (-1, 1))], [(i, 5e6 + y * 1e4, 3e5 + x * 1e4) for i, y, x in cloud(30, 8, (-1, 1))]),  # metres
    (cloud(150, 9, (0, 0.02)), cloud(150, 10, (0, 0.02))),           # dense
])
def test_nearest_site_both_ways(frame, points, sites):
    p = frame(points, "p int, latitude double, longitude double")
    s = frame(sites, "s int, latitude double, longitude double")
    want = brute_nearest(points, sites)
    assert {r["p"]: r["s"] for r in spatial.nearest_site(p, s, "p", "s").collect()} == want
    assert {r["p"]: r["s"] for r in spatial.nearest_site(p, s, "p", "s", max_array_sites=1).collect()} == want
    assert {r["p"]: r["s"] for r in spatial.nearest_by_grid(p, s, "p", "s").collect()} == want


def test_a_point_meets_no_more_sites_than_may_be_nearest(spark):
    """Points of a cell meet lists of their cell: no row per point and site, and nothing sorted before it is dealt."""
    pts = spark.range(300).select("id", (F.rand(1) * 3).alias("latitude"), (F.rand(2) * 3).alias("longitude"))
    text = spatial.nearest_by_grid(pts, pts.withColumnRenamed("id", "s"), "id", "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" in text and "RepartitionByExpression [id" in text


def test_copies_of_a_shape_are_measured_once(frame):
    square = lambda a, b: [[float(x), float(y)] for x, y in ((a, a), (b, a), (b, b), (a, b), (a, a))]
    areas = frame([(i, [square(0, 2)]) for i in range(40)] + [(99, [square(1, 3)]), (98, [square(8, 9)])], "k int, rings array<array<array<double>>>")
    spots = frame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.5, 2.5), (4, 7.0, 7.0)], "p int, latitude double, longitude double")
    got = spatial.per_shape(spots, areas, "p", "k", F.count("*").alias("n"), F.min("p").alias("first"), F.max("p").alias("last"))
    assert {(r["k"], r["n"], r["first"], r["last"]) for r in got.collect()} == {(i, 2, 1, 2) for i in range(40)} | {(99, 2, 2, 3)}
    held = spatial.points_in_shapes(spots, areas, "p", "k")
    assert {(r["p"], r["k"]) for r in held.collect()} == {(p, i) for p in (1, 2) for i in range(40)} | {(2, 99), (3, 99)}
    by_form = spatial._points_in_forms(spots, spatial._formed(areas, "rings"), "p", "rings", "latitude", "longitude")
    assert by_form.count() == 4


def test_nearest_safe(frame):
    rows = [("A", "Kritis", 0.0, 0.0), ("B", "Aman", 0.0, 1.0), ("C", "Aman", 0.0, -1.0), ("D", "Waspada", 0.0, 0.1)]
    df = frame(rows, "k string, tier string, latitude double, longitude double")
    got = spatial.nearest_safe(df, "k").collect()
    assert [(r["k"], r["safe_key"], r["distance_km"], r["minutes"]) for r in got] == [("A", "B", 111.0, 222.0)]
    km = spatial.nearest_safe(df, "k", great_circle=True).first()["distance_km"]
    assert km == pytest.approx(111.195, abs=0.01)
    assert spatial.nearest_safe(df.where("tier <> 'Aman'"), "k").count() == 0


def test_haversine(frame):
    row = frame([(0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double").select(
        haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("km")
    ).first()
    assert row["km"] == pytest.approx(math.pi * 6371.0088)


def test_points_in_shapes_with_holes_and_parts(spark, tmp_path):
    square = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    tall = [[20, 0], [21, 0], [20.5, 300], [20, 0]]
    shapes = [
        ("hole", "Polygon", [square(0, 10), square(4, 6)]), ("parts", "MultiPolygon", [[square(-3, -1)], [square(10, 12)]]),
        ("tall", "Polygon", [tall]), ("tiny", "Polygon", [square(5, 5.001)]), ("line", "Polygon", [[[1, 1], [1, 1]]]), ("other", "Point", [1, 1]),
    ]
    features = [{"type": "Feature", "properties": {"kecamatan_norm": k, "latitude": 0, "longitude": 0}, "geometry": {"type": t, "coordinates": c}} for k, t, c in shapes]
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, features)))
    spots = {1: (1, 1), 2: (5, 5), 3: (4, 5), 4: (6, 5), 5: (0, 5), 6: (10, 5), 7: (10, 11), 8: (-2, -2), 9: (20.5, 150), 10: (20.1, 290), 11: (5.0005, 5.0005), 12: (500, 0), 13: (5, 0), 14: (5, 10)}
    points = [(k, float(y), float(x)) for k, (x, y) in spots.items()] + [(99, None, 1.0), (98, float("nan"), 1.0), (97, float("inf"), 1.0)]
    frame = spark.createDataFrame(points, "id int, latitude double, longitude double")
    wanted = {(1, "hole"), (2, "tiny"), (4, "hole"), (5, "hole"), (7, "parts"), (8, "parts"), (9, "tall"), (11, "tiny"), (13, "hole")}
    for path, one in ((tmp_path / "b.geojson", True), (tmp_path / "lines.json", False)):
        got = spatial.points_in_shapes(frame, read_boundaries(spark, str(path), one_document_per_file=one), "id", "kecamatan_norm").collect()
        assert len(got) == len(wanted) and {(r["id"], r["kecamatan_norm"]) for r in got} == wanted
    none = read_boundaries(spark, str(tmp_path / "b.geojson")).limit(0)
    assert spatial.points_in_shapes(frame, none, "id", "kecamatan_norm").count() == 0


def test_geojson_rings(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"kecamatan_norm": "A B", "latitude": 1.0, "longitude": 1.0},
         "geometry": {"type": "Polygon", "coordinates": [square]}},
        {"type": "Feature", "properties": {"kecamatan_norm": "C", "latitude": 5.0, "longitude": 1.0},
         "geometry": {"type": "Polygon", "coordinates": [square]}},
    ]}
    (tmp_path / "b.geojson").write_text(json.dumps(doc, indent=1))
    df = spatial.inside(read_geojson(spark, str(tmp_path / "b.geojson")))
    assert {r["kecamatan_norm"]: r["inside"] for r in df.collect()} == {"A B": True, "C": False}
