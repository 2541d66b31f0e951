import pytest
from conftest import as_dicts

from seatplan.operators import quality as q


def by_metric(df):
    return {r["metric"]: r for r in as_dicts(df)}


def rows_with_blanks(frame, blanks, total):
    return frame([(None if i < blanks else "x",) for i in range(total)], "c string")


@pytest.mark.parametrize("blanks, total, status, value", [
    (0, 100, "PASS", "0 (0.0%)"), (499, 10_000, "WARN", "499 (4.99%)"), (5, 100, "FAIL", "5 (5.0%)"), (0, 0, "PASS", "0 (0.0%)"),
])
def test_completeness_bounds(frame, blanks, total, status, value):
    row = q.run_checks(rows_with_blanks(frame, blanks, total), "t", "bronze", [q.completeness("c")]).first()
    assert (row["status"], row["value"], row["metric"]) == (status, value, "null_c")


def test_spaces_and_empty_text_are_blank(frame):
    df = frame([("",), ("  ",), (None,), ("a",)], "c string")
    assert q.run_checks(df, "t", "bronze", [q.completeness("c")]).first()["value"] == "3 (75.0%)"


def test_all_checks_of_a_table_in_one_row_pass(frame):
    df = frame([("Kec. A", "A A", "AA", "mei", "Mei", -1), ("A", "A", "AA", "MEI", "Mei", None)],
               "raw string, norm string, key string, p string, pn string, seats int")
    checks = [q.row_count(2), q.key_consistency("raw", "norm", "key", 1), q.period_consistency("p", "pn"),
              q.not_negative("seats", "neg"), q.not_null("seats", "nul")]
    got = by_metric(q.run_checks(df, "t", "silver", checks))
    assert (got["row_count_vs_ckan"]["value"], got["row_count_vs_ckan"]["status"]) == ("2/2", "PASS")
    k = got["distinct_kecamatan(raw/norm/key)"]
    assert (k["value"], k["status"], k["note"] != "") == ("2/2/1", "PASS", True)
    assert got["distinct_periode(raw/norm)"]["value"] == "2/1"
    assert (got["neg"]["value"], got["neg"]["status"]) == ("1", "FAIL")
    assert (got["nul"]["value"], got["nul"]["status"]) == ("1 (50.0%)", "WARN")


def test_text_that_is_no_number_is_counted_not_raised(frame):
    df = frame([("-",), ("-3",), ("4",), (None,)], "seats string")
    row = q.run_checks(df, "t", "silver", [q.not_negative("seats", "neg")]).first()
    assert (row["value"], row["status"], row["note"]) == ("2", "FAIL", "1 not numeric")


def test_uniqueness(frame):
    df = frame([("a", 1), ("a", 1), ("a", None), ("a", None)], "k string, n int")
    row = q.uniqueness(df, "t", "silver", ["k", "n"], "dup").first()
    assert (row["value"], row["status"]) == ("2", "WARN")
    assert q.uniqueness(df.limit(0), "t", "silver", ["k"], "dup").first()["status"] == "PASS"


def test_joinability(frame):
    left, right = frame([("a",), ("a",), ("b",)], "k string"), frame([("a",), ("c",)], "k string")
    row = q.joinability(left, right, "k", "l x r", "silver", "match", "left over").first()
    assert (row["value"], row["status"], row["note"]) == ("1/2", "WARN", "left over")
    assert q.joinability(left, left, "k", "l x l", "silver", "match", "left over").first()["note"] == ""
    assert [r["k"] for r in q.unmatched_keys(left, right, "k").collect()] == ["b"]


def test_types(frame):
    df = frame([("1",), ("-",), (None,)], "r string")
    assert q.column_type(df, "r", "t", "silver", "m", "n").first()["status"] == "WARN"
    assert q.column_type(df, "absent", "t", "silver", "m", "n").first()["value"] == "n/a"
    assert q.unreadable_numbers(df, "r", "t", "silver", "m").first()["value"] == "1"


def test_missing_table_is_a_failed_row_and_counts(spark, frame):
    broken = q.guarded(spark, lambda: spark.read.parquet("/no/such/place"), "t", "bronze", "reconciliation", "rows")
    fine = q.run_checks(frame([(1,)], "a int"), "t", "bronze", [q.row_count(1)])
    report = q.assemble_report([broken, fine])
    assert (broken.first()["status"], broken.first()["value"]) == ("FAIL", "ERROR")
    assert {r["status"]: r["checks"] for r in q.summary(report).collect()} == {"FAIL": 1, "PASS": 1}
