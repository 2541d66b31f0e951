import random

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from seatplan.operators import quality as q
from seatplan.operators import quantiles, reports, spatial


def test_quantiles_equal_the_built_in_ones(frame):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice([None, rng.random(), float(rng.randrange(5))])) for _ in range(3000)]
    df = frame([*rows, ("only nulls", None), ("one", 7.0)], "g string, v double")
    at = (0.0, 0.1, 0.25, 0.5, 0.77, 1.0)
    got = as_dicts(quantiles.quantiles(df, "v", at, ["g"]), "g")
    built_in = as_dicts(df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(f) for f in at])).alias("q")), "g")
    assert set(got) == set(built_in)
    for g, row in built_in.items():
        assert got[g]["quantiles"] == (row["q"] if row["q"] else [None] * len(at))


def test_a_hot_group_spreads_over_partitions(spark, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together again
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    counts = quantiles.value_counts(spark.range(40_000).select(F.lit("hot").alias("g"), (F.col("id") % 9973).alias("v")), "v", ["g"])
    rows = [r["count"] for r in counts.groupBy("_part").count().collect()]
    assert len(rows) > 1 and max(rows) < 2 * 9973 / len(rows)


def test_mean_and_median_of_nothing_and_of_ties(frame):
    assert tuple(reports.mean_and_median(frame([], "v double"), "v").first()) == (None, None)
    assert tuple(reports.mean_and_median(frame([(2.0,), (2.0,), (2.0,), (None,)], "v double"), "v").first()) == (2.0, 2.0)


def test_quartiles_keep_the_type_of_the_ends(frame):
    row = reports.quartiles(frame([("a", 1), ("a", 4), ("a", 2)], "g string, v int"), "g", "v").first().asDict()
    assert row == {"g": "a", "low": 1, "q1": 1.5, "q2": 2.0, "q3": 3.0, "high": 4}


def test_a_check_that_fails_in_a_task_costs_no_other(spark, frame):
    df = frame([("1",), ("x",)], "c string")
    broken = lambda: q.run_checks(df.withColumn("n", F.col("c").cast("int")), "t", "bronze", [q.not_null("n", "n_null")])
    fine = lambda: q.run_checks(df, "t", "bronze", [q.not_null("c", "c_null")])
    report = as_dicts(q.assemble_report([q.settled(spark, b, "t", "bronze", "validity", m) for b, m in ((broken, "n_null"), (fine, "c_null"))]), "metric")
    assert (report["n_null"]["status"], report["n_null"]["value"]) == ("FAIL", "ERROR")
    assert report["c_null"]["status"] == "PASS"


@pytest.mark.parametrize("most", [0, 500])
def test_places_without_a_finite_coordinate_take_no_part(frame, most):
    inf = float("inf")
    points = frame([(1, 0.0, 0.0), (2, inf, 0.0), (3, None, 0.0)], "p long, latitude double, longitude double")
    sites = frame([(10, 0.0, 3.0), (11, 0.0, -inf), (12, float("nan"), 0.0)], "s long, latitude double, longitude double")
    got = [tuple(r) for r in spatial.nearest_site(points, sites, "p", "s", max_array_sites=most).collect()]
    assert got == [(1, 10, 3.0)]
