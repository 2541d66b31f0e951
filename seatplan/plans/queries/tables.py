"""Sources and sinks over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.functions.numbers import add_or_zero, or_zero, ratio
from seatplan.functions.text import slashed
from seatplan.operators.quality import unmatched_keys
from seatplan.plans.catalog import query
from seatplan.plans.standins import table
from seatplan.session import work_path
from seatplan.sources import readers, writers

ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
LAYERS = {
    "bronze": ("orders", "lineitem", "events", "documents", "pages", "conversations"),
    "silver": ("customer", "supplier", "part", "embeddings", "labels", "benchmark"),
    "gold": ("nation", "region"),
}
EVENT_SCHEMA = "event_id bigint, event_type string, user_id bigint, value double, props string"


def _counts_sql(pairs) -> str:
    return "\nUNION ALL ".join(pairs)


@query(
    "table_roundtrip",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    """Written partitioned, read back, aggregated."""
    root = work_path(spark, "table-roundtrip")
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    writers.overwrite_table(rows, root, "lineitem", partition_by=["l_returnflag"])
    return (
        readers.read_table(spark, root, "lineitem").groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    )


@query(
    "layer_inventory",
    _counts_sql(
        f"""SELECT '{layer}' AS layer, '{t}' AS "table", count(*) AS rows, CAST(1 AS BIGINT) AS files FROM {t}"""
        for layer, ts in LAYERS.items() for t in ts
    ),
)
def _(spark, sf):
    return writers.layer_inventory((layer, t, table(spark, sf, t)) for layer, ts in LAYERS.items() for t in ts)


@query("table_counts", _counts_sql(f"""SELECT '{t}' AS "table", count(*) AS rows FROM {t}""" for t in ALL_TABLES))
def _(spark, sf):
    return writers.row_counts({t: table(spark, sf, t) for t in ALL_TABLES})


@query("sample_rows", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer ORDER BY c_custkey LIMIT 5")
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return writers.sample_rows(rows, ["c_custkey"], 5)


def _landed_events(spark, sf, label: str) -> str:
    """The events as landing files: lines that are JSON arrays of 500 records."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value", "props")
    return writers.write_json_arrays(events, work_path(spark, label), "event_id", 500)


@query(
    "bronze_ingest",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, 'events' AS _source,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY event_type""",
)
def _(spark, sf):
    """Landing files read with a given schema, stamped with lineage, written as a table, read back."""
    landed = readers.read_json_array(
        spark, _landed_events(spark, sf, "landing"), EVENT_SCHEMA, one_document_per_file=False
    )
    root = work_path(spark, "bronze")
    jobs = {"events": lambda: writers.write_counted(readers.with_lineage(landed, "events"), root, "events", source=landed)}
    (done,) = writers.each_isolated(jobs)
    if done.error:
        raise RuntimeError(done.error)
    return (
        readers.read_table(spark, root, "events").groupBy("event_type", "_source")
        .agg(
            F.count("*").alias("n"), F.countDistinct("user_id").alias("users"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


PAGE_SCHEMA = (
    "resource string, success boolean, result struct<records: array<struct<"
    "_id: bigint, part_key: bigint, brand: string, size: int>>, total: bigint>"
)


def _part_pages(spark, sf):
    """The parts as pages of 100 records; one failed page per ten repeats its records and must be ignored."""
    part = table(spark, sf, "part")
    total = part.agg(F.count("*")).scalar()
    record = F.struct(
        F.col("p_partkey").alias("_id"), F.col("p_partkey").alias("part_key"),
        F.col("p_brand").alias("brand"), F.col("p_size").alias("size"),
    )
    pages = (
        part.withColumn("_page", F.floor(F.col("p_partkey") / 100))
        .groupBy("_page").agg(F.sort_array(F.collect_list(record)).alias("records"))
        .withColumn("total", total)
        .withColumn("success", F.explode(F.when(F.col("_page") % 10 == 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    )
    doc = F.struct(F.lit("parts").alias("resource"), "success", F.struct("records", "total").alias("result"))
    path = work_path(spark, "pages")
    pages.select(F.to_json(doc).alias("value")).write.mode("errorifexists").text(path)
    return spark.read.schema(PAGE_SCHEMA).json(path)


@query(
    "paged_envelope_flatten",
    "SELECT p_partkey AS part_key, p_brand AS brand, p_size AS size, 'parts' AS source_resource_id FROM part",
)
def _(spark, sf):
    return readers.flatten_pages(_part_pages(spark, sf), F.col("resource")).drop("ingested_at")


@query("paged_envelope_complete", "SELECT 'parts' AS resource, count(*) AS fetched, count(*) AS total, true AS complete FROM part")
def _(spark, sf):
    return readers.pages_complete(_part_pages(spark, sf), "resource")


@query(
    "resource_route_union",
    """SELECT 'res-nation' AS source_resource_id, 'sby-nation' AS topic, 'nation' AS key, n_name AS name,
        n_regionkey AS parent, CAST(NULL AS DOUBLE) AS balance FROM nation
    UNION ALL SELECT 'res-customer', 'sby-customer', 'customer', c_name, c_nationkey, c_acctbal FROM customer
    UNION ALL SELECT 'res-supplier', 'sby-supplier', 'supplier', s_name, s_nationkey, s_acctbal FROM supplier""",
)
def _(spark, sf):
    def resource(name: str) -> readers.Resource:
        return readers.Resource(f"res-{name}", f"sby-{name}", name, name)

    nation = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("parent"))
    customer = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("parent"), F.col("c_acctbal").alias("balance")
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("parent"), F.col("s_acctbal").alias("balance")
    )
    return readers.route_union({resource("nation"): nation, resource("customer"): customer, resource("supplier"): supplier})


@query(
    "csv_export_roundtrip",
    """SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS sizes,
        CAST(sum(CAST(p_retailprice AS DECIMAL(18, 2))) AS DOUBLE) AS prices FROM part GROUP BY p_brand""",
)
def _(spark, sf):
    path = work_path(spark, "csv")
    writers.export_csv(table(spark, sf, "part"), path, ["p_partkey", "p_brand", "p_size", "p_retailprice"])
    back = readers.read_csv(spark, path, "p_partkey bigint, p_brand string, p_size int, p_retailprice double")
    return back.groupBy("p_brand").agg(
        F.count("*").alias("parts"), F.sum("p_size").alias("sizes"),
        F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").alias("prices"),
    )


@query(
    "scalar_functions",
    r"""SELECT p_partkey, upper(p_name) AS up, replace(p_name, ' ', '') AS squeezed,
        upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS titled, least(p_size, 20) AS capped,
        greatest(p_size, 10) AS floored, CAST(ceil(p_size / 7) AS BIGINT) AS units, abs(p_size - 25) AS away,
        p_size % 7 AS rest, coalesce(nullif(p_size, 1), 0) AS no_one, CASE WHEN p_size - 1 > 0 THEN 100 / (p_size - 1) END AS guarded,
        CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey AS VARCHAR) AS pair,
        CAST(round(CAST(p_retailprice AS DECIMAL(18, 2)) / 1, 1) AS DOUBLE) AS rounded FROM part""",
)
def _(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.regexp_replace("p_name", r"\s+", "").alias("squeezed"),
        F.initcap(F.lower("p_type")).alias("titled"),
        F.least(size, F.lit(20)).alias("capped"),
        F.greatest(size, F.lit(10)).alias("floored"),
        F.ceil(size / 7).alias("units"),
        F.abs(size - 25).alias("away"),
        (size % 7).alias("rest"),
        or_zero(F.nullif(size, F.lit(1))).alias("no_one"),
        ratio(F.lit(100), size - 1).alias("guarded"),
        slashed(size, F.col("p_partkey")).alias("pair"),
        F.round("p_retailprice", 1).alias("rounded"),
    )


@query(
    "filter_project_cast",
    """SELECT CAST(o_orderkey AS INTEGER) AS order_no, CAST(floor(o_totalprice) AS BIGINT) AS price,
        strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(year(o_orderdate) AS INTEGER) AS tahun FROM orders
    WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997 AND o_orderpriority IS NOT NULL""",
)
def _(spark, sf):
    """The year filter is written as a date range so that it reaches the scan."""
    day = F.col("o_orderdate")
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1998-01-01"))
    return (
        table(spark, sf, "orders")
        .where((F.col("o_orderstatus") == "F") & (day >= first) & (day < last) & F.col("o_orderpriority").isNotNull())
        .select(
            F.col("o_orderkey").cast("int").alias("order_no"),
            F.floor("o_totalprice").cast("long").alias("price"),
            F.date_format(day, "yyyy-MM-dd").alias("day"),
            F.year(day).alias("tahun"),
        )
    )


@query("null_to_zero_sum", """SELECT l_orderkey, CAST(sum(coalesce(nullif(l_linenumber, 3), 0) + coalesce(nullif(l_linenumber, 5), 0)) AS BIGINT) AS total
    FROM lineitem GROUP BY l_orderkey""")
def _(spark, sf):
    n = F.col("l_linenumber")
    pair = add_or_zero(F.nullif(n, F.lit(3)), F.nullif(n, F.lit(5)))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(pair).alias("total"))


@query("distinct_keys", "SELECT DISTINCT l_suppkey, year(l_shipdate)::INTEGER AS tahun FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("tahun")).distinct()


@query(
    "unmatched_keys",
    "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return unmatched_keys(table(spark, sf, "customer"), orders, "c_custkey")
