"""Data-quality checks: every rule is an aggregate, every table is read once.

A check names the aggregates it needs and turns them into one report row. All
checks of a table run in the same aggregation and are stacked to long form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatplan.functions.numbers import or_zero
from seatplan.functions.text import count_with_share, is_blank, slashed

REPORT_COLUMNS = ("table", "layer", "dimension", "metric", "value", "status", "note")
# Share of blanks that turns a warning into a failure; months in a year;
# metric names and notes as the report prints them.
BLANK_FAIL_PCT = 5
MONTHS_IN_YEAR = 12
NOTE_LENGTH = 80
ROW_COUNT_METRIC = "row_count_vs_ckan"
KEY_METRIC = "distinct_kecamatan(raw/norm/key)"
KEY_NOTE = "key menyatukan variasi spasi & case"
PERIOD_METRIC = "distinct_periode(raw/norm)"
PERIOD_NOTE = "norm distandarkan ke <=12 bulan"
GRAIN_METRIC = "dup_on_grain(kec_key,periode,tahun)"
MATCH_METRIC = "kecamatan_match(matched/total)"
MATCH_NOTE = "kecamatan penduduk yg tdk ketemu di sekolah"
RATIO_NOTE = "tipe beda dgn sd/smp/mi_rasio (numeric)"


@dataclass(frozen=True)
class Check:
    dimension: str
    metric: str
    measures: Mapping[str, Column]
    report: Callable[[Mapping[str, Column]], tuple[Column, Column, Column | str]]


def _pass_if(condition: Column, otherwise: str) -> Column:
    return F.when(condition, "PASS").otherwise(otherwise)


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def row_count(expected: int) -> Check:
    return Check(
        "reconciliation", ROW_COUNT_METRIC, {"rows": F.count("*")},
        lambda m: (slashed(m["rows"], F.lit(expected)), _pass_if(m["rows"] == expected, "WARN"), ""),
    )


def completeness(column: str) -> Check:
    def report(m):
        share = _pct(m["blank"], m["rows"])
        status = F.when(m["blank"] == 0, "PASS").when(share < BLANK_FAIL_PCT, "WARN").otherwise("FAIL")
        return count_with_share(m["blank"], share), status, ""

    return Check(
        "completeness", f"null_{column}", {"blank": F.count_if(is_blank(F.col(column))), "rows": F.count("*")}, report
    )


def key_consistency(raw: str, norm: str, key: str, expected: int) -> Check:
    measures = {n: F.countDistinct(c) for n, c in (("raw", raw), ("norm", norm), ("key", key))}
    return Check(
        "consistency", KEY_METRIC, measures,
        lambda m: (
            slashed(m["raw"], m["norm"], m["key"]),
            _pass_if(m["key"] == expected, "WARN"),
            F.when(m["key"] < m["norm"], KEY_NOTE).otherwise(""),
        ),
    )


def period_consistency(raw: str, norm: str, most: int = MONTHS_IN_YEAR) -> Check:
    return Check(
        "consistency", PERIOD_METRIC, {"raw": F.countDistinct(raw), "norm": F.countDistinct(norm)},
        lambda m: (slashed(m["raw"], m["norm"]), _pass_if(m["norm"] <= most, "FAIL"), PERIOD_NOTE),
    )


def not_negative(column: str, metric: str) -> Check:
    """Values below zero. A text that is no number is bad too and is counted in the note; it does not end the run."""
    number = F.col(column).try_cast("double")
    unread = F.col(column).isNotNull() & number.isNull()
    return Check(
        "validity", metric, {"bad": F.count_if((number < 0) | unread), "unread": F.count_if(unread)},
        lambda m: (
            m["bad"].cast("string"),
            _pass_if(m["bad"] == 0, "FAIL"),
            F.when(m["unread"] > 0, F.concat(m["unread"].cast("string"), F.lit(" not numeric"))).otherwise(""),
        ),
    )


def not_null(column: str, metric: str) -> Check:
    return Check(
        "validity", metric, {"bad": F.count_if(F.col(column).isNull()), "rows": F.count("*")},
        lambda m: (count_with_share(m["bad"], _pct(m["bad"], m["rows"])), _pass_if(m["bad"] == 0, "WARN"), ""),
    )


def run_checks(df: DataFrame, table: str, layer: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of a table in one aggregation."""
    measures = [v.alias(f"_{i}_{n}") for i, c in enumerate(checks) for n, v in c.measures.items()]
    rows = []
    for i, check in enumerate(checks):
        value, status, note = check.report({n: F.col(f"_{i}_{n}") for n in check.measures})
        note = F.lit(note) if isinstance(note, str) else note
        fields = (F.lit(table), F.lit(layer), F.lit(check.dimension), F.lit(check.metric), value, status, note)
        rows.append(F.struct(*[f.alias(n) for f, n in zip(fields, REPORT_COLUMNS, strict=True)]))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def uniqueness(df: DataFrame, table: str, layer: str, grain: Sequence[str], metric: str) -> DataFrame:
    """Rows beyond one per grain. Grouped apart from the other checks: the grain is as wide as the table."""
    surplus = df.groupBy(*grain).agg(F.count("*").alias("_n")).agg(or_zero(F.sum(F.col("_n") - 1)).alias("dup"))
    return _row(surplus, table, layer, "uniqueness", metric, F.col("dup").cast("string"), _pass_if(F.col("dup") == 0, "WARN"), F.lit(""))


def joinability(left: DataFrame, right: DataFrame, key: str, table: str, layer: str, metric: str, note: str) -> DataFrame:
    """Distinct keys of the left side that the right side knows."""
    known = right.select(key).distinct().withColumn("_known", F.lit(1))
    matched = (
        left.select(key).distinct().join(known, key, "left")
        .agg(F.count("*").alias("total"), F.count("_known").alias("matched"))
    )
    missing = F.col("total") - F.col("matched")
    return _row(
        matched, table, layer, "joinability", metric, slashed(F.col("matched"), F.col("total")),
        _pass_if(missing == 0, "WARN"), F.when(missing > 0, note).otherwise(""),
    )


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def column_type(df: DataFrame, column: str, table: str, layer: str, metric: str, note: str) -> DataFrame:
    """Warn when a measure is stored as text; a schema question, answered without reading rows."""
    kind = dict(df.dtypes).get(column, "n/a")
    one = df.sparkSession.range(1)
    return _row(one, table, layer, "validity", metric, F.lit(kind), F.lit("WARN" if kind == "string" else "PASS"), F.lit(note))


def unreadable_numbers(df: DataFrame, column: str, table: str, layer: str, metric: str, as_type: str = "double") -> DataFrame:
    """How many texts of a column do not read as numbers."""
    failed = F.count_if(F.col(column).isNotNull() & F.col(column).cast("string").try_cast(as_type).isNull())
    return _row(df.agg(failed.alias("bad")), table, layer, "validity", metric, F.col("bad").cast("string"),
                _pass_if(F.col("bad") == 0, "WARN"), F.lit(""))


def guarded(spark: SparkSession, build: Callable[[], DataFrame], table: str, layer: str, dimension: str, metric: str) -> DataFrame:
    """A check whose table cannot be read becomes a failed row instead of an error."""
    try:
        return build()
    except PySparkException as e:
        reason = (e.getCondition() or str(e))[:NOTE_LENGTH]
        return _row(spark.range(1), table, layer, dimension, metric, F.lit("ERROR"), F.lit("FAIL"), F.lit(reason))


def settled(spark: SparkSession, build: Callable[[], DataFrame], table: str, layer: str, dimension: str, metric: str) -> DataFrame:
    """A check carried out by itself: its few rows, or one failed row if it cannot be planned or fails while it runs.

    ``guarded`` sees only what fails while the plan is built; here a task's error costs its own check and no other.
    """
    try:
        rows = build().select(*REPORT_COLUMNS).collect()
    except (PySparkException, Py4JJavaError) as e:
        condition = e.getCondition() if isinstance(e, PySparkException) else None
        rows = [(table, layer, dimension, metric, "ERROR", "FAIL", (condition or str(e))[:NOTE_LENGTH])]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in REPORT_COLUMNS))


def assemble_report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def summary(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count("*").alias("checks"))


def _row(df, table, layer, dimension, metric, value, status, note) -> DataFrame:
    fields = (F.lit(table), F.lit(layer), F.lit(dimension), F.lit(metric), value, status, note)
    return df.select(*[f.alias(n) for f, n in zip(fields, REPORT_COLUMNS, strict=True)])
