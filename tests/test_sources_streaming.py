import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatplan.sources import jdbc, readers, writers
from seatplan.streaming import topics

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_landing_arrays_with_lineage(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "name": "x"}, {"id": 2, "name": "y"}], indent=2))
    (tmp_path / "b.json").write_text(json.dumps([{"id": 3, "name": "z"}]))
    df = readers.with_lineage(readers.read_json_array(spark, str(tmp_path), "id bigint, name string"), "src")
    rows = df.collect()
    assert {(r["id"], r["_hdfs_source"].rsplit("/", 1)[1]) for r in rows} == {(1, "a.json"), (2, "a.json"), (3, "b.json")}
    assert {r["_source"] for r in rows} == {"src"} and all(r["_ingested_at"] for r in rows)
    assert readers.with_lineage(df.select("id"), "src", "elsewhere").first()["_hdfs_source"] == "elsewhere"


def test_arrays_one_per_line(spark, tmp_path):
    df = spark.range(25).withColumn("name", F.col("id").cast("string"))
    path = writers.write_json_arrays(df, str(tmp_path / "lines"), "id", 10)
    back = readers.read_json_array(spark, path, "id bigint, name string", one_document_per_file=False)
    assert sorted(r["id"] for r in back.collect()) == list(range(25))


def test_pages(spark, tmp_path):
    schema = "resource string, success boolean, result struct<records: array<struct<_id: int, v: string>>, total: bigint>"
    docs = [
        {"resource": "r", "success": True, "result": {"records": [{"_id": 1, "v": "a"}, {"_id": 2, "v": "b"}], "total": 3}},
        {"resource": "r", "success": True, "result": {"records": [{"_id": 3, "v": "c"}], "total": 3}},
        {"resource": "r", "success": False, "result": None},
        {"resource": "q", "success": True, "result": {"records": [], "total": 5}},
    ]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(d) for d in docs))
    pages = spark.read.schema(schema).json(str(tmp_path))
    flat = readers.flatten_pages(pages, F.col("resource"), F.lit("2026-01-02 03:04:05").cast("timestamp"))
    assert flat.columns == ["v", "source_resource_id", "ingested_at"]
    assert sorted(map(tuple, flat.collect())) == [(v, "r", "2026-01-02 03:04:05") for v in "abc"]
    done = {r["resource"]: r["complete"] for r in readers.pages_complete(pages, "resource").collect()}
    assert done == {"r": True, "q": False}


def test_route_union_fills_missing_columns(frame):
    a, b = readers.Resource("1", "sby-a", "a", "a"), readers.Resource("2", "sby-b", "b", "b")
    got = readers.route_union({a: frame([(1,)], "x int"), b: frame([(2,)], "y int")})
    assert {(r["topic"], r["x"], r["y"]) for r in got.collect()} == {("sby-a", 1, None), ("sby-b", None, 2)}


def test_one_failing_table_does_not_stop_the_rest(spark, tmp_path):
    root = str(tmp_path)
    jobs = {
        "good": lambda: writers.write_counted(spark.range(3), root, "good"),
        "empty": lambda: writers.write_counted(spark.range(0), root, "empty", source=spark.range(0)),
        "none": lambda: writers.write_counted(spark.range(9).where("id < 0"), root, "none"),
        "bad": lambda: writers.write_counted(spark.read.parquet(f"{root}/absent"), root, "bad"),
        "late": lambda: writers.write_counted(spark.range(2), root, "late"),
    }
    got = {o.table: o for o in writers.each_isolated(jobs)}
    assert (got["good"].rows, got["late"].rows, got["empty"].skipped, got["none"].rows) == (3, 2, True, 0)
    assert got["bad"].error == "PATH_NOT_FOUND"
    assert not (tmp_path / "empty").exists()


def test_overwrite_replaces_the_schema_and_inventory_counts(spark, tmp_path):
    root = str(tmp_path)
    writers.overwrite_table(spark.range(5), root, "t")
    writers.overwrite_table(spark.range(2).withColumn("x", F.lit(1)), root, "t")
    back = readers.read_table(spark, root, "t")
    assert back.columns == ["id", "x"] and back.count() == 2
    row = writers.layer_inventory([("gold", "t", back)]).first()
    assert (row["layer"], row["table"], row["rows"]) == ("gold", "t", 2)
    path = writers.export_csv(back, f"{root}/csv", ["id"])
    assert readers.read_csv(spark, path, "id bigint").count() == 2


class FakeWriter:
    def __init__(self, log):
        self.log = log

    def format(self, kind):
        self.log["format"] = kind
        return self

    def options(self, **options):
        self.log["options"] = options
        return self

    def mode(self, mode):
        self.log["mode"] = mode
        return self

    def save(self):
        self.log["saved"] = True


def test_publishing_keeps_the_store_s_table(monkeypatch):
    """No database runs here: what is checked is what would be asked of it."""
    log = {}

    class Frame:
        write = FakeWriter(log)

    done = jdbc.publish(Frame(), "jdbc:postgresql://h/db", "gold", user="u", password="p")
    assert (done.table, log["format"], log["mode"], log["saved"]) == ("gold", "jdbc", "overwrite", True)
    assert log["options"]["truncate"] == "true" and log["options"]["dbtable"] == "gold" and log["options"]["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.read(None, "u", "t", split_on="id")


def test_decode_keeps_what_does_not_parse(frame):
    msgs = frame([("t", "1", '{"id": 1, "name": "a"}'), ("t", "2", '{"id": 2, "na'), ("t", "3", None)], "topic string, key string, value string")
    got = {r["key"]: r for r in topics.decode(msgs, RECORD).collect()}
    assert (got["1"]["id"], got["1"][topics.MALFORMED]) == (1, None)
    assert got["2"][topics.MALFORMED] == '{"id": 2, "na'
    assert got["3"]["id"] is None


def test_messages_round_trip(frame):
    df = frame([(1, "a"), (2, None)], "id bigint, name string")
    msgs = topics.to_messages(df, "sby-x", F.col("id"))
    assert {(r["topic"], r["key"]) for r in msgs.collect()} == {("sby-x", "1"), ("sby-x", "2")}
    assert sorted(map(tuple, topics.decode(msgs, RECORD).select("id", "name").collect())) == [(1, "a"), (2, None)]
    assert topics.topic_counts(msgs).first()["messages"] == 2


def land_and_count(spark, source, out, check, dedup=False):
    stream = topics.read_growing(spark, str(source), "*.parquet", spark.read.parquet(str(source)).schema)
    if dedup:
        stream = topics.drop_republished(stream.withColumn("arrived", F.current_timestamp()), ["id"], "arrived")
    topics.land(stream, str(out), str(check), every=None).awaitTermination()
    return spark.read.parquet(str(out))


def test_restart_adds_only_what_is_new(spark, tmp_path):
    source, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    rows = lambda a, b, t: spark.range(a, b).withColumn("topic", F.lit(t))
    rows(0, 10, "x").write.mode("append").parquet(str(source))
    assert land_and_count(spark, source, out, check).count() == 10
    assert land_and_count(spark, source, out, check).count() == 10
    rows(10, 15, "y").write.mode("append").parquet(str(source))
    got = land_and_count(spark, source, out, check)
    assert {r["topic"]: r["messages"] for r in topics.topic_counts(got).collect()} == {"x": 10, "y": 5}


def test_republished_rows_arrive_once_across_runs(spark, tmp_path):
    source, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    for upto in (10, 12):  # the second publish repeats the first and adds two
        spark.range(upto).withColumn("topic", F.lit("x")).write.mode("append").parquet(str(source))
        got = land_and_count(spark, source, out, check, dedup=True)
        assert sorted(r["id"] for r in got.collect()) == list(range(upto))


def test_copies_beyond_any_watermark_land_once(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))

    def publish(rows):
        spark.createDataFrame(rows, "id long, `a b` string, at long").write.mode("append").parquet(source)
        stream = topics.read_growing(spark, source, "*.parquet", spark.read.parquet(source).schema)
        topics.land_new(stream, out, check, ["id", "a b"], ["at"], every=None).awaitTermination()
        return sorted((r["id"] or 0, r["a b"] or "", r["at"], r[topics.LANDED_BATCH]) for r in spark.read.parquet(out).collect())

    first = [(1, "x", 10, 0), (2, "", 12, 0)]
    assert publish([(1, "x", 9), (1, "x", 10), (2, None, 11), (2, None, 12)]) == first
    assert publish([(1, "x", 99), (2, None, 99), (2, "y", 5), (None, "z", 1)]) == [(0, "z", 1, 1), *first, (2, "y", 5, 1)]
    assert publish([(1, "x", 100), (None, "z", 2)]) == [(0, "z", 1, 1), *first, (2, "y", 5, 1)]
    # a trigger that failed half-way is repeated: its folder is replaced
    stream = topics.read_growing(spark, source, "*.parquet", spark.read.parquet(source).schema)
    topics.land_new(stream, str(tmp_path / "out2"), str(tmp_path / "check2"), ["id", "a b"], ["at"], every=None).awaitTermination()
    topics.land_new(stream, str(tmp_path / "out2"), str(tmp_path / "check3"), ["id", "a b"], ["at"], every=None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 4


def test_flush_interval_writes_only_when_something_came(spark, tmp_path):
    source, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    spark.range(4).withColumn("topic", F.lit("x")).write.parquet(str(source))
    stream = topics.read_growing(spark, str(source), "*.parquet", spark.read.parquet(str(source)).schema)
    running = topics.land(stream, str(out), str(check), every="1 second")
    try:
        running.processAllAvailable()
        before = sorted(p.name for p in out.rglob("*.parquet"))
        running.processAllAvailable()
    finally:
        running.stop()
    assert before and sorted(p.name for p in out.rglob("*.parquet")) == before
    assert spark.read.parquet(str(out)).count() == 4
