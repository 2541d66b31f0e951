"""Data-quality report over the cleaned stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from seatplan.operators import quality as q
from seatplan.plans.catalog import query
from seatplan.plans.standins import KEY, NAME, PERIOD, population, pupil_fact, registry, sql, sql_round, table
from seatplan.session import work_path
from seatplan.sources import readers, writers

EXPECTED_DISTRICTS = 25
EXPECTED_ROWS = {"orders": 15000, "lineitem": 60000, "events": 10000, "supplier": 101}
BLANKS = {"full": 1_000_000, "few": 50, "many": 10}
_COLS = ", ".join(f'"{c}"' for c in q.REPORT_COLUMNS)


def _row_sql(table_, layer, dimension, metric, value, status, note="''", source="") -> str:
    return (
        f"""SELECT {table_} AS "table", '{layer}' AS layer, '{dimension}' AS dimension, {metric} AS metric, """
        f"""{value} AS value, {status} AS status, {note} AS note {source}"""
    )


def reconcile(spark, sf):
    return q.assemble_report(
        [q.run_checks(table(spark, sf, t), t, "bronze", [q.row_count(n)]) for t, n in EXPECTED_ROWS.items()]
    )


RECONCILE = "\nUNION ALL ".join(
    _row_sql(f"'{t}'", "bronze", "reconciliation", f"'{q.ROW_COUNT_METRIC}'", f"count(*) || '/{n}'",
             f"CASE WHEN count(*) = {n} THEN 'PASS' ELSE 'WARN' END", source=f"FROM {t}")
    for t, n in EXPECTED_ROWS.items()
)


@query("dq_reconcile", RECONCILE)
def _(spark, sf):
    return reconcile(spark, sf)


def _with_blanks(spark, sf):
    """Three columns of customer names: none, some and many of them blank."""
    holes = [
        F.when(F.col("c_custkey") % every != every - 1, F.col("c_name")).otherwise(F.lit("  ")).alias(c)
        for c, every in BLANKS.items()
    ]
    return table(spark, sf, "customer").select(*holes)


def complete(spark, sf):
    return q.run_checks(_with_blanks(spark, sf), "customer", "bronze", [q.completeness(c) for c in BLANKS])


COMPLETE = sql(
    "\nUNION ALL ".join(
        _row_sql("'customer'", "bronze", "completeness", f"'null_{c}'", "blank || ' (' || pct || '%)'",
                 "CASE WHEN blank = 0 THEN 'PASS' WHEN pct < 5 THEN 'WARN' ELSE 'FAIL' END",
                 source=f"FROM (SELECT blank, {sql_round('blank / rows * 100', 2)} AS pct FROM (SELECT count(*) AS rows, "
                        f"count(*) FILTER (c_custkey % {every} = {every - 1}) AS blank FROM customer))")
        for c, every in BLANKS.items()
    )
)


@query("dq_complete", COMPLETE)
def _(spark, sf):
    return complete(spark, sf)


def consistency(spark, sf):
    checks = [
        q.key_consistency("kecamatan", NAME, KEY, EXPECTED_DISTRICTS),
        q.period_consistency("periode", PERIOD),
    ]
    return q.run_checks(pupil_fact(spark, sf), "pupils", "silver", checks)


_CONSISTENCY = (
    _row_sql("'pupils'", "silver", "consistency", f"'{q.KEY_METRIC}'", "r || '/' || n || '/' || k",
             f"CASE WHEN k = {EXPECTED_DISTRICTS} THEN 'PASS' ELSE 'WARN' END",
             f"CASE WHEN k < n THEN '{q.KEY_NOTE}' ELSE '' END",
             "FROM (SELECT count(DISTINCT kecamatan) AS r, count(DISTINCT district_name) AS n, count(DISTINCT district_key) AS k FROM fact)")
    + "\nUNION ALL "
    + _row_sql("'pupils'", "silver", "consistency", f"'{q.PERIOD_METRIC}'", "r || '/' || n",
               "CASE WHEN n <= 12 THEN 'PASS' ELSE 'FAIL' END", f"'{q.PERIOD_NOTE}'",
               "FROM (SELECT count(DISTINCT periode) AS r, count(DISTINCT period_norm) AS n FROM fact)")
)


@query("dq_consistency", sql(_CONSISTENCY, "fact"))
def _(spark, sf):
    return consistency(spark, sf)


def unique(spark, sf):
    return q.assemble_report(
        [
            q.uniqueness(table(spark, sf, "lineitem"), "lineitem", "silver", ["l_orderkey", "l_linenumber"], "dup_on_grain"),
            q.uniqueness(pupil_fact(spark, sf), "pupils", "silver", [KEY, PERIOD, "tahun"], q.GRAIN_METRIC),
        ]
    )


def _dup_sql(t, grain, metric, source) -> str:
    return _row_sql(f"'{t}'", "silver", "uniqueness", f"'{metric}'", "CAST(dup AS VARCHAR)",
                    "CASE WHEN dup = 0 THEN 'PASS' ELSE 'WARN' END",
                    source=f"FROM (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dup FROM (SELECT count(*) AS n FROM {source} GROUP BY {grain}))")


_UNIQUE = (
    _dup_sql("lineitem", "l_orderkey, l_linenumber", "dup_on_grain", "lineitem")
    + "\nUNION ALL "
    + _dup_sql("pupils", "district_key, period_norm, tahun", q.GRAIN_METRIC, "fact")
)


@query("dq_unique", sql(_UNIQUE, "fact"))
def _(spark, sf):
    return unique(spark, sf)


def valid(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 40 != 0, F.col("c_acctbal")).alias("balance"), F.col("c_acctbal") + F.lit(2000)
    )
    checks = [q.not_negative("balance", "balance_negative"), q.not_null("balance", "balance_null")]
    return q.run_checks(rows, "customer", "silver", checks)


VALID = (
    _row_sql("'customer'", "silver", "validity", "'balance_negative'", "CAST(bad AS VARCHAR)",
             "CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END",
             source="FROM (SELECT count(*) FILTER (c_acctbal < 0 AND c_custkey % 40 <> 0) AS bad FROM customer)")
    + "\nUNION ALL "
    + _row_sql("'customer'", "silver", "validity", "'balance_null'",
               f"bad || ' (' || {sql_round('bad / rows * 100', 2)} || '%)'",
               "CASE WHEN bad = 0 THEN 'PASS' ELSE 'WARN' END",
               source="FROM (SELECT count(*) AS rows, count(*) FILTER (c_custkey % 40 = 0) AS bad FROM customer)")
)


@query("dq_valid", VALID)
def _(spark, sf):
    return valid(spark, sf)


def types(spark, sf):
    fact = pupil_fact(spark, sf)
    note = q.RATIO_NOTE
    return q.assemble_report(
        [
            q.column_type(fact, "mts_rasio", "pupils", "silver", "mts_rasio_dtype", note),
            q.column_type(fact, "mts_murid", "pupils", "silver", "mts_murid_dtype", note),
            q.unreadable_numbers(fact, "mts_rasio", "pupils", "silver", "mts_rasio_unreadable"),
        ]
    )


_NOTE = f"'{q.RATIO_NOTE}'"
_TYPES = "\nUNION ALL ".join(
    [
        _row_sql("'pupils'", "silver", "validity", "'mts_rasio_dtype'", "'string'", "'WARN'", _NOTE),
        _row_sql("'pupils'", "silver", "validity", "'mts_murid_dtype'", "'bigint'", "'PASS'", _NOTE),
        _row_sql("'pupils'", "silver", "validity", "'mts_rasio_unreadable'", "CAST(bad AS VARCHAR)",
                 "CASE WHEN bad = 0 THEN 'PASS' ELSE 'WARN' END",
                 source="FROM (SELECT count(*) FILTER (mts_rasio IS NOT NULL AND TRY_CAST(mts_rasio AS DOUBLE) IS NULL) AS bad FROM fact)"),
    ]
)


@query("dq_types", sql(_TYPES, "fact"))
def _(spark, sf):
    return types(spark, sf)


def joinable(spark, sf):
    """Districts with people against districts with schools, and customers against orders, of whom not all have one."""
    people, schools = population(spark, sf), registry(spark, sf)
    customers, orders = (table(spark, sf, t).select(F.col(c).alias("custkey")) for t, c in (("customer", "c_custkey"), ("orders", "o_custkey")))
    note, metric = q.MATCH_NOTE, q.MATCH_METRIC
    return q.assemble_report(
        [
            q.joinability(people, schools, KEY, "people x schools", "silver", metric, note),
            q.joinability(customers, orders, "custkey", "customers x orders", "silver", metric, note),
        ]
    )


def _join_sql(t, key, left, right) -> str:
    return _row_sql(f"'{t}'", "silver", "joinability", f"'{q.MATCH_METRIC}'", "m || '/' || n",
                    "CASE WHEN n = m THEN 'PASS' ELSE 'WARN' END",
                    f"CASE WHEN n > m THEN '{q.MATCH_NOTE}' ELSE '' END",
                    f"FROM (SELECT count(*) AS n, count(*) FILTER (k IN ({right})) AS m FROM (SELECT DISTINCT {key} AS k FROM {left}))")


_JOINABLE = "\nUNION ALL ".join([
    _join_sql("people x schools", "district_key", "pop", "SELECT district_key FROM reg"),
    _join_sql("customers x orders", "c_custkey", "customer", "SELECT o_custkey FROM orders"),
])


@query("dq_joinable", sql(_JOINABLE, "pop", "reg"))
def _(spark, sf):
    return joinable(spark, sf)


def missing_table(spark, sf):
    return q.guarded(
        spark, lambda: q.run_checks(spark.read.parquet(f"{sf}/no_such_table.parquet"), "no_such_table", "bronze", [q.row_count(1)]),
        "no_such_table", "bronze", "reconciliation", q.ROW_COUNT_METRIC,
    )


_MISSING = _row_sql("'no_such_table'", "bronze", "reconciliation", f"'{q.ROW_COUNT_METRIC}'", "'ERROR'", "'FAIL'", "'PATH_NOT_FOUND'")

def failing(spark, sf):
    """A sound check, one whose tasks meet text that is no number, and one whose table is missing."""
    lines = table(spark, sf, "lineitem")
    parts = {
        "lineitem": lambda: q.run_checks(lines, "lineitem", "bronze", [q.not_null("l_returnflag", "flag_null")]),
        "unreadable": lambda: q.run_checks(
            lines.withColumn("flag", F.col("l_returnflag").cast("int")), "unreadable", "bronze", [q.not_null("flag", "flag_null")]
        ),
        "no_such_table": lambda: q.run_checks(spark.read.parquet(f"{sf}/no_such_table.parquet"), "no_such_table", "bronze", [q.row_count(1)]),
    }
    return q.assemble_report([q.settled(spark, build, t, "bronze", "validity", "flag_null") for t, build in parts.items()])


_FAILED = _row_sql("'unreadable'", "bronze", "validity", "'flag_null'", "'ERROR'", "'FAIL'", "'CAST_INVALID_INPUT'")


@query("dq_failing_checks", "\nUNION ALL ".join([
    _row_sql("'lineitem'", "bronze", "validity", "'flag_null'", f"bad || ' (' || {sql_round('bad / rows * 100', 2)} || '%)'",
             "CASE WHEN bad = 0 THEN 'PASS' ELSE 'WARN' END",
             source="FROM (SELECT count(*) AS rows, count(*) FILTER (l_returnflag IS NULL) AS bad FROM lineitem)"),
    _FAILED, _FAILED.replace("unreadable", "no_such_table").replace("CAST_INVALID_INPUT", "PATH_NOT_FOUND"),
]))
def _(spark, sf):
    return failing(spark, sf)


PARTS = (reconcile, complete, consistency, unique, valid, types, joinable, missing_table)
_ALL_SQL = "\nUNION ALL ".join(f"({p})" for p in (RECONCILE, COMPLETE, _CONSISTENCY, _UNIQUE, VALID, _TYPES, _JOINABLE, _MISSING))


def full_report(spark, sf):
    return q.assemble_report([part(spark, sf) for part in PARTS])


@query("dq_report_table", sql(f"SELECT {_COLS} FROM ({_ALL_SQL})", "fact", "pop", "reg"))
def _(spark, sf):
    """The whole report, written as a table and read back."""
    root = work_path(spark, "dq")
    writers.overwrite_table(full_report(spark, sf), root, "gold_data_quality_report")
    return readers.read_table(spark, root, "gold_data_quality_report")


@query("dq_summary", sql(f"SELECT status, count(*) AS checks FROM ({_ALL_SQL}) GROUP BY status", "fact", "pop", "reg"))
def _(spark, sf):
    return q.summary(full_report(spark, sf))
