import pytest
from pyspark.sql import functions as F

from seatplan.operators import serving
from seatplan.operators.ranking import page
from seatplan.sources import versioned


@pytest.fixture
def trend(frame):
    rows = [("ASEMROWO", 2026, 2), ("ASEMROWO", 2025, 1), ("B", 2025, 9)]
    return frame(rows, "kecamatan_key string, year int, v int")


def test_lookup_takes_any_spelling_and_rejects_unknown(trend):
    got = serving.key_trend(trend, "kecamatan_key", "asem rowo", "year").collect()
    assert [r["v"] for r in got] == [1, 2]
    with pytest.raises(serving.UnknownKey):
        serving.key_trend(trend, "kecamatan_key", "nowhere", "year")


def test_catalog(spark, trend):
    stamped = trend.withColumn("_gold_created_at", F.current_timestamp()).withColumn("id", F.lit(1))
    tables = serving.Catalog(spark, {"t": ("a table", stamped)})
    listed = tables.list_tables().collect()
    assert [(r["table_name"], r["description"], r["record_count"], r["total_tables"]) for r in listed] == [("t", "a table", 3, 1)]
    assert tables.table("t").columns == ["kecamatan_key", "year", "v"]
    rows = tables.page("t", [F.asc("kecamatan_key"), F.asc("year")], limit=2, offset=1).collect()
    assert [(r["v"], r["record_count"]) for r in rows] == [(2, 3), (9, 3)]
    assert tables.page("t", [F.asc("year")], offset=50).count() == 0
    assert tables.count("t").first()["count"] == 3
    with pytest.raises(serving.UnknownTable):
        tables.page("u", [F.asc("year")])


def test_ranked_filters_before_the_cut(frame):
    df = frame([(3, "USB"), (1, "USB"), (2, "RKB"), (None, "USB")], "rank int, label string")
    got = serving.ranked(df, "rank", top=2, label="label", wanted="usb").collect()
    assert [(r["rank"], r["count"]) for r in got] == [(1, 3), (3, 3)]
    assert serving.ranked(df, "rank", top=31).count() == 4
    assert serving.ranked(df, "rank", top=32).count() == 4
    for top in (0, 32):
        with pytest.raises(ValueError):
            serving.ranked(df, "rank", top=top, most=serving.MOST_RANKED)


def test_pages_of_tied_rows_fit_together(frame):
    df = frame([(i, i % 2) for i in range(20)], "v int, year int")
    near = [r["v"] for at in (0, 8) for r in page(df, [F.asc("year")], limit=8, offset=at).collect()]
    deep = [r["v"] for r in page(df, [F.asc("year")], limit=8, offset=16, deep=8).collect()]
    assert sorted(near + deep) == list(range(20))


def test_cluster_lists(frame):
    df = frame([(2, "TINGGI", 1, "b"), (1, "KRITIS", 5, "c"), (1, "KRITIS", 2, "a")], "priority_rank int, priority_label string, r int, n string")
    assert [r["n"] for r in serving.cluster_list(df, "r").collect()] == ["a", "c", "b"]
    assert serving.cluster_list(df, "r", "tinggi").count() == 1
    assert serving.cluster_summary(df, "n", "kritis").first()["members"] == ["a", "c"]


def test_versions_keep_their_schema(frame, spark, tmp_path):
    path = str(tmp_path / "table")
    assert versioned.current_version(spark, path) is None
    with pytest.raises(versioned.UnknownVersion):
        versioned.read_version(spark, path)
    one = frame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    two = frame([(2, "b", True), (3, "c", True), (4, "d", True)], "k int, v string, fresh boolean")
    assert [versioned.write_version(one, path), versioned.write_version(two, path, "UPDATE")] == [0, 1]
    assert versioned.current_version(spark, path) == 1
    assert versioned.read_version(spark, path, 0).columns == ["k", "v"]
    assert versioned.read_version(spark, path).columns == ["k", "v", "fresh"]
    assert [(r["version"], r["operation"], r["rows"]) for r in versioned.history(spark, path).collect()] == [(1, "UPDATE", 3), (0, "WRITE", 3)]
    changes = versioned.diff(versioned.read_version(spark, path, 0), versioned.read_version(spark, path), ["k"], ["v"])
    assert {r["k"]: r["change"] for r in changes.collect()} == {1: "removed", 3: "changed", 4: "added"}


def test_a_failed_write_leaves_no_version(frame, spark, tmp_path):
    path = str(tmp_path / "table")
    versioned.write_version(frame([(1,)], "k int"), path)
    broken = frame([("x",)], "k string").select(F.col("k").cast("int").alias("k"))  # ANSI: fails when run
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        versioned.write_version(broken, path)
    assert versioned.current_version(spark, path) == 0
    assert versioned.read_version(spark, path).count() == 1
    assert versioned.write_version(frame([(2,)], "k int"), path) == 1


def test_history_shows_the_newest_five(frame, spark, tmp_path):
    path = str(tmp_path / "table")
    for i in range(6):
        versioned.write_version(frame([(i,)], "k int"), path)
    assert [r["version"] for r in versioned.history(spark, path).collect()] == [5, 4, 3, 2, 1]
