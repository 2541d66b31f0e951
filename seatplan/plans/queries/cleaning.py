"""Cleaning and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.functions.text import contains_text, is_blank
from seatplan.operators import cleaning
from seatplan.plans.catalog import query
from seatplan.plans.standins import (
    dirty_name,
    dirty_period,
    keyed,
    nations,
    sql,
    sql_key,
    sql_norm,
    sql_period,
    table,
    _dirty,
    _MONTH_LIST,
)


def _dirty_customers(spark, sf):
    rows = table(spark, sf, "customer").join(nations(spark, sf, "c_nationkey"), "c_nationkey")
    return rows.select("c_custkey", dirty_name("n_name", "c_custkey").alias("kecamatan"), "c_mktsegment")


_CUSTOMERS = f"SELECT c_custkey, {_dirty('n_name', 'c_custkey')} AS kecamatan, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey"


@query(
    "trim_strings",
    sql(
        "SELECT c_custkey, trim(kecamatan) AS kecamatan, trim(padded) AS padded, '  as is ' AS _source FROM d",
        d=f"SELECT *, '  ' || c_mktsegment || ' ' AS padded FROM ({_CUSTOMERS})",
    ),
)
def _(spark, sf):
    rows = _dirty_customers(spark, sf).select(
        "c_custkey", "kecamatan", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("padded"), F.lit("  as is ").alias("_source")
    )
    return cleaning.trim_strings(rows)


@query(
    "normalize_keys",
    sql(f"SELECT c_custkey, {sql_norm('kecamatan')} AS district_name, {sql_key('kecamatan')} AS district_key FROM d", d=_CUSTOMERS),
)
def _(spark, sf):
    return keyed(_dirty_customers(spark, sf)).select("c_custkey", "district_name", "district_key")


@query(
    "normalize_period",
    sql(
        f"SELECT o_orderkey, {sql_period('periode')} AS period_norm FROM d",
        d=f"""SELECT o_orderkey, CASE m % 3 WHEN 0 THEN ' ' || upper({_MONTH_LIST}[m])
            WHEN 1 THEN lower({_MONTH_LIST}[m]) || '  ' ELSE {_MONTH_LIST}[m] END AS periode
        FROM (SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders)""",
    ),
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.lit("x").alias("kecamatan"), dirty_period("month(o_orderdate)").alias("periode")
    )
    return keyed(rows, "periode").select("o_orderkey", "period_norm")


@query(
    "blank_predicate",
    """SELECT event_type, count(*) FILTER (note IS NULL OR trim(note) = '') AS blank, count(*) AS n FROM (
        SELECT event_type, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE event_type END AS note
        FROM events) GROUP BY event_type""",
)
def _(spark, sf):
    seed = F.col("event_id") % 4
    note = F.when(seed == 1, "").when(seed == 2, "  ").when(seed == 3, F.col("event_type"))
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count_if(is_blank(note)).alias("blank"), F.count("*").alias("n")
    )


_LINE = ("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "dedup_grain",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
        FROM lineitem) WHERE rn = 1""",
)
def _(spark, sf):
    """Latest shipment per order line; the rest of the row settles ties."""
    rows = table(spark, sf, "lineitem").select(*_LINE)
    return cleaning.one_per_grain(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"], keep="last").drop("l_shipdate")


@query(
    "drop_blank_keys",
    sql(
        """SELECT coalesce(k, '') AS k, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 5 = 0 THEN ' ' WHEN c_custkey % 5 = 1 THEN NULL
            ELSE c_mktsegment END AS k FROM customer) WHERE k IS NOT NULL AND trim(k) <> '' GROUP BY k"""
    ),
)
def _(spark, sf):
    seed = F.col("c_custkey") % 5
    k = F.when(seed == 0, " ").when(seed > 1, F.col("c_mktsegment"))
    rows = cleaning.drop_blank_keys(table(spark, sf, "customer").select(k.alias("k")), "k")
    return rows.groupBy("k").agg(F.count("*").alias("n"))


@query(
    "cast_columns",
    """SELECT event_id, TRY_CAST(raw AS DOUBLE) AS amount, CASE WHEN raw IS NOT NULL AND TRY_CAST(raw AS DOUBLE) IS NULL
        THEN 1 ELSE 0 END AS rejects FROM (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN '-'
        WHEN event_id % 6 = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS raw FROM events)""",
)
def _(spark, sf):
    seed = F.col("event_id") % 6
    raw = F.when(seed == 0, "-").when(seed > 1, F.col("user_id").cast("string"))
    rows = table(spark, sf, "events").select("event_id", raw.alias("amount"))
    return cleaning.cast_columns(rows, {"amount": "double"}, rejects_as="rejects")


@query(
    "name_search",
    "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')",
)
def _(spark, sf):
    return table(spark, sf, "part").where(contains_text(F.col("p_name"), "RING")).select("p_partkey", "p_name")
