import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from seatplan.functions.text import is_blank, join_key, normalize_name, normalize_period
from seatplan.operators import cleaning


@pytest.mark.parametrize(
    "raw, name, key",
    [
        ("  Kec. Asem  Rowo ", "ASEM ROWO", "ASEMROWO"),
        ("kel.ASEMROWO", "ASEMROWO", "ASEMROWO"),
        ("Kecamatan X", "KECAMATAN X", "KECAMATANX"),
        ("kec.kec. y", "KEC. Y", "KEC.Y"),
        ("tab\there", "TAB HERE", "TABHERE"),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_names(frame, raw, name, key):
    row = frame([(raw,)], "x string").select(
        normalize_name(F.col("x")).alias("n"), join_key(normalize_name(F.col("x"))).alias("k")
    ).first()
    assert (row["n"], row["k"]) == (name, key)


def test_period(frame):
    got = frame([(" mARET ",), ("Xx",), (None,)], "x string").select(normalize_period(F.col("x")).alias("p")).collect()
    assert [r["p"] for r in got] == ["Maret", "Xx", None]


def test_blank(frame):
    got = frame([("",), ("  ",), (None,), ("a",)], "x string").select(is_blank(F.col("x")).alias("b")).collect()
    assert [r["b"] for r in got] == [True, True, True, False]


def test_trim_leaves_lineage_and_numbers(frame):
    df = cleaning.trim_strings(frame([(" a ", " raw ", 3)], "name string, _source string, n int"))
    assert df.first().asDict() == {"name": "a", "_source": " raw ", "n": 3}


def test_keys_and_period(frame):
    df = cleaning.add_keys(frame([(" Kec. A  b", " mei ")], "kecamatan string, periode string"), "kecamatan", "periode")
    row = df.first()
    assert (row["kecamatan_norm"], row["kecamatan_key"], row["periode_norm"]) == ("A B", "AB", "Mei")


def test_one_per_grain_follows_the_order_however_rows_are_spread(frame):
    rows = [("a", 1, 5, "x"), ("a", 1, 7, "y"), ("a", 2, 1, None), ("b", None, 1, "p"), ("b", None, 1, "q")]
    df = frame(rows, "k string, g int, seen int, v string")
    want = {("a", 1): (7, "y"), ("a", 2): (1, None), ("b", None): (1, "q")}
    for parts in (1, 3, 8):
        got = cleaning.one_per_grain(df.repartition(parts), ["k", "g"], ["seen"], keep="last").collect()
        assert {(r["k"], r["g"]): (r["seen"], r["v"]) for r in got} == want
    first = cleaning.one_per_grain(df, ["k", "g"], ["seen"]).collect()
    assert {(r["k"], r["g"]): r["v"] for r in first}[("a", 1)] == "x"


def test_one_per_grain_carries_maps_and_bare_grains(frame):
    df = frame([("a", 1, {"p": 1}), ("a", 2, {"p": 2})], "k string, seen int, m map<string,int>")
    assert cleaning.one_per_grain(df, ["k"], ["seen"], keep="last").first()["m"] == {"p": 2}
    assert cleaning.one_per_grain(df.select("k"), ["k"]).count() == 1


def test_cast_counts_rejects(frame):
    df = cleaning.cast_columns(frame([("1.5", "x"), (None, "2"), ("?", "!")], "a string, b string"), {"a": "double", "b": "int"}, "bad")
    assert [tuple(r) for r in df.collect()] == [(1.5, None, 1), (None, 2, 0), (None, None, 2)]


def test_blank_keys_are_dropped(frame):
    assert as_dicts(cleaning.drop_blank_keys(frame([("",), (" ",), (None,), ("A",)], "k string"), "k")) == [{"k": "A"}]
