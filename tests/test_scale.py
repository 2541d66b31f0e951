"""What has to stay true of the plans when the data is large and one key is hot."""

import re

import pytest
from pyspark.sql import functions as F

from seatplan.operators import clusters, spatial
from seatplan.operators.cleaning import one_per_grain
from seatplan.operators.snapshots import latest_per_key
from seatplan.plans import catalog, standins

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def hot(spark, n=30_000):
    """A third of all rows share one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997).alias("k"),
        (F.col("id") * 7919 % 10_007).alias("seen"), F.col("id").alias("v"),
    )


@pytest.mark.parametrize("build", [
    lambda df: one_per_grain(df, ["k"], ["seen"], keep="last"),
    lambda df: latest_per_key(df, ["k"], [F.col("seen")]),
])
def test_hot_keys_collapse_before_the_shuffle(spark, build):
    df = hot(spark)
    text = plan(build(df))
    assert "Window" not in text and "partial_max" in text
    best = {}
    for r in df.collect():
        best[r["k"]] = max(best.get(r["k"], (-1, -1)), (r["seen"], r["v"]))
    assert {r["k"]: (r["seen"], r["v"]) for r in build(df).collect()} == best


def test_orders_are_counted_before_they_meet_customers(spark, no_broadcast):
    text = plan(standins.population_raw(spark, SF))
    people_side = text[text.index("o_custkey"):]
    assert len(re.findall(r"Exchange hashpartitioning\(o_custkey", people_side)) == 2  # one per side, none for the join again
    assert "partial_count" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = catalog.load()[0]["filter_project_cast"](spark, SF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "o_custkey" not in read


@pytest.mark.parametrize("build", [
    lambda df: clusters.silhouette_rows(df, "x", "label"),
    lambda df: clusters.davies_bouldin(df, "x", "label"),
])
def test_cluster_scores_never_pair_or_shuffle_rows(spark, no_broadcast, build):
    df = standins.table(spark, SF, "embeddings").select(F.col("embedding").alias("x"), "label")
    text = plan(build(df))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # rows are aggregated where they are: whatever is shuffled by label is partial statistics
    assert not re.search(r"Exchange hashpartitioning\(label#\d+, \d+\)[^\n]*\n[^\n]*(?:FileScan|ColumnarToRow|Project)", text)


def test_nearest_site_by_grid_has_only_equi_joins(spark, no_broadcast):
    pts = spark.range(50).select("id", (F.rand(1) * 3).alias("latitude"), (F.rand(2) * 3).alias("longitude"))
    sites = pts.select(F.col("id").alias("s"), "latitude", "longitude")
    text = plan(spatial.nearest_by_grid(pts, sites, "id", "s"))
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text


def test_latest_year_filter_reaches_the_fact_scan(spark):
    text = plan(standins.registry_totals(spark, SF))
    fact = text[: text.index("BroadcastExchange")] if "BroadcastExchange" in text else text
    assert re.search(r"Filter \(.*year\(cast\(l_shipdate#\d+ as date\)\) = Subquery", fact)
