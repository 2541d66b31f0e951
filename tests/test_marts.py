import math
import random

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from seatplan.functions.calendar import month_rank
from seatplan.operators import capacity as cap
from seatplan.operators import index, projection, ranking
from seatplan.operators.snapshots import latest_snapshot


def test_month_rank(frame):
    got = frame([("Maret",), ("Xx",), (None,)], "m string").select(month_rank(F.col("m")).alias("r")).collect()
    assert [r["r"] for r in got] == [3, None, None]


def test_latest_snapshot_orders_months_by_number(frame):
    rows = [
        ("A", 2024, "Desember", 1), ("A", 2024, "April", 2), ("A", 2023, "Desember", 9),
        ("B", 2024, "Xx", 3), ("B", 2024, "Januari", 4),
        ("C", None, "Desember", 5), ("C", 2020, "Januari", 6),
        ("D", None, None, 7),
    ]
    got = latest_snapshot(frame(rows, "k string, y int, m string, v int").repartition(5), "k", "y", "m")
    assert got.columns == ["k", "y", "m", "v"]
    assert {r["k"]: r["v"] for r in got.collect()} == {"A": 1, "B": 4, "C": 6, "D": 7}


def test_latest_snapshot_carries_maps_and_empty_input(frame):
    df = frame([("A", 2024, "Mei", {"p": 1}), ("A", 2024, "Juni", {"p": 2})], "k string, y int, m string, v map<string,int>")
    assert latest_snapshot(df, "k", "y", "m").first()["v"] == {"p": 2}
    assert latest_snapshot(df.limit(0), "k", "y", "m").count() == 0


def test_cohort_one_person_per_age(frame):
    people = frame([("A", "a", age, 1) for age in range(16)], "k string, name string, age int, n int")
    ages = projection.age_vector_from_long(people, "k", "age", "n", "name")
    got = {r["year"]: r for r in as_dicts(projection.cohort_projection(ages, ["k"], 2025, 20))}
    assert (got[2025]["demand_sd"], got[2025]["demand_smp"], got[2025]["demand_total"]) == (6, 3, 9)
    assert (got[2030]["demand_sd"], got[2030]["demand_smp"]) == (6, 3)
    assert (got[2033]["demand_sd"], got[2033]["demand_smp"]) == (5, 3)  # ages -1..4 and 5..7
    assert got[2045]["demand_total"] == 0


def test_cohort_matches_brute_force(frame):
    rng = random.Random(1)
    rows = [(f"D{d}", "x", rng.randrange(16), rng.randrange(50)) for d in range(7) for _ in range(40)]
    ages = projection.age_vector_from_long(frame(rows, "k string, name string, age int, n int"), "k", "age", "n", "name")
    got = {(r["k"], r["year"]): r for r in as_dicts(projection.cohort_projection(ages, ["k"], 2025, 8))}
    for d in range(7):
        for k in range(9):
            for band, (lo, hi) in projection.BANDS.items():
                want = sum(n for key, _, a, n in rows if key == f"D{d}" and lo <= a + k <= hi)
                assert got[(f"D{d}", 2025 + k)][band] == want


def test_wide_ages_count_nulls_as_none(frame):
    cols = [f"{w}_{s}" for w in projection.AGE_WORDS for s in projection.SEX_SUFFIXES]
    schema = "k string, name string, " + ", ".join(f"{c} int" for c in cols)
    wide = frame([("A", "one", *([1, None] * 17)), ("A", "another", *([2, 3] * 17))], schema)
    got = projection.age_vector_from_wide(wide, "k", "name").collect()
    assert len(got) == 1 and got[0]["name"] == "another"  # one key stays one row
    assert all(got[0][f"usia_{a}"] == 6 for a in range(16))
    assert {(r["age"], r["people"]) for r in projection.unpivot_ages(projection.age_vector_from_wide(wide, "k"), ["k"]).collect()} == {
        (a, 6) for a in range(16)
    }


def registry(frame):
    rows = [
        ("A", "A", 2023, 999, 9, 9), ("A", "A", 2024, 100, 3, None), ("A", "A ", 2024, None, 2, 1),
        ("B", "B", 2024, 10, 1, 1), ("", "", 2024, 50, 1, 1), (None, None, 2024, 7, 1, 1),
    ]
    return frame(rows, "k string, name string, tahun int, pagu int, ruang int, rombel int")


TOTALS = {"seats": "pagu", "rooms": "ruang", "class_groups": "rombel"}


def test_registry_totals_use_the_latest_year(frame):
    got = as_dicts(cap.registry_totals(registry(frame), "k", "tahun", TOTALS, name="name"), "k")
    assert set(got) == {"A", "B"}
    assert got["A"] == {"k": "A", "name": "A", "seats": 100, "rooms": 5, "class_groups": 1, "schools": 2, "registry_year": 2024}
    kept = as_dicts(cap.registry_totals(registry(frame), "k", "tahun", TOTALS, keep_blank_keys=True), "k")
    assert set(kept) == {"A", "B", ""}


def test_capacity_is_at_least_what_is_served(frame):
    totals = cap.registry_totals(registry(frame), "k", "tahun", TOTALS)
    latest = frame([("B", 5, 6, None, 1)], "k string, sd_murid int, smp_murid int, mi_murid int, mts_murid int")
    got = as_dicts(cap.capacity_floor(totals, cap.pupils_served(latest, "k"), "k"), "k")
    assert (got["A"]["capacity"], got["A"]["capacity_source"]) == (100, "seats")
    assert (got["B"]["capacity"], got["B"]["pupils"], got["B"]["capacity_source"]) == (12, 12, "pupils")


def gap_rows(frame, demand, capacity):
    d = frame([(k, 2030, v) for k, v in demand.items()], "k string, year int, demand_total long")
    c = frame([(k, *v) for k, v in capacity.items()], "k string, capacity long, schools long")
    return cap.demand_gap(d, c, "k")


def test_gap_edges(frame):
    got = as_dicts(gap_rows(frame, {"A": 150, "B": 5, "C": 0, "D": 7}, {"A": (100, 2), "B": (0, 1), "C": (10, 1)}), "k")
    assert (got["A"]["gap"], got["A"]["unserved"], got["A"]["utilization_pct"]) == (50, 50, 150.0)
    assert (got["B"]["capacity"], got["B"]["utilization_pct"], got["B"]["capacity_known"]) == (0, None, True)
    assert (got["C"]["gap"], got["C"]["unserved"], got["C"]["utilization_pct"]) == (-10, 0, 0.0)
    assert (got["D"]["capacity"], got["D"]["unserved"], got["D"]["capacity_known"]) == (0, 7, False)


def test_recommendation_thresholds_and_ties(frame):
    over = {"E0": 0, "E1": 1, "E32": 32, "E33": 33, "E40": 40, "Z1": 1}
    demand = {k: 80 + v for k, v in over.items()} | {"NOSCHOOL": 3}
    got = as_dicts(cap.recommend(gap_rows(frame, demand, {k: (80, 2) for k in over}), "k", 2030), "k")
    want = {"E0": ("CUKUP", 0), "E1": ("RKB", 1), "E32": ("RKB", 1), "E33": ("RKB", 2), "E40": ("USB", 2), "NOSCHOOL": ("USB", 1), "Z1": ("RKB", 1)}
    assert {k: (r["recommendation"], r["rooms_needed"]) for k, r in got.items()} == want
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1]["priority_rank"])] == ["E40", "E33", "E32", "NOSCHOOL", "E1", "Z1", "E0"]


@pytest.mark.parametrize("score, label", [(70, "KRITIS"), (69.99, "TINGGI"), (50, "TINGGI"), (30, "SEDANG"), (0.01, "RENDAH"), (0, "AMAN")])
def test_categories(frame, score, label):
    assert frame([(float(score),)], "s double").select(index.categorize(F.col("s")).alias("c")).first()["c"] == label


def test_index_components(frame):
    rows = [
        ("A", 100.0, 200.0, 100.0, 2, 200.0, 100.0),   # deficit .5, full use, growth 1
        ("B", 200.0, 100.0, 100.0, 2, 100.0, 0.0),     # shrinking
        ("C", 0.0, 0.0, 0.0, 0, 0.0, 0.0),             # nothing at all
        ("D", 10.0, 90.0, 10.0, 1, 900.0, 80.0),       # growth and use above their limits
    ]
    inputs = frame(rows, "k string, demand_base double, demand_target double, capacity double, schools int, utilization_target double, deficit_target double")
    got = as_dicts(index.gap_index(inputs, "k"), "k")
    assert (got["A"]["deficit_rate"], got["A"]["utilization_norm"], got["A"]["growth_rate"], got["A"]["index_score"]) == (0.5, 1.0, 1.0, 75.0)
    assert (got["B"]["growth_rate"], got["B"]["index_score"], got["B"]["index_category"]) == (0.0, 15.0, "RENDAH")
    assert (got["C"]["index_score"], got["C"]["index_category"], got["C"]["index_rank"]) == (0.0, "AMAN", 4)
    assert (got["D"]["growth_rate"], got["D"]["utilization_norm"]) == (1.0, 1.0)
    points = as_dicts(index.contributions(index.gap_index(inputs, "k")), "k")["A"]
    assert math.isclose(sum(points[f"{c}_points"] for c in index.WEIGHTS), 75.0)


def test_global_rank_counts_every_row_once(spark):
    rows = [(i, 0 if i % 3 else i % 50) for i in range(3000)]  # two thirds share one value
    df = spark.createDataFrame(rows, "id int, v int").repartition(7)
    for parts in (None, 1, 6):
        got = {r["id"]: r["r"] for r in ranking.global_rank(df, [F.desc("v"), F.asc("id")], "r", partitions=parts).collect()}
        want = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda t: (-t[1], t[0])), start=1)}
        assert got == want


def test_pages_and_top(spark):
    df = spark.range(25)
    assert [r["id"] for r in ranking.page(df, [F.asc("id")], limit=3, offset=23).collect()] == [23, 24]
    assert ranking.page(df, [F.asc("id")], limit=1, offset=99).count() == 0
    assert ranking.page(df, [F.asc("id")], limit=10_000).count() == 25
    for bad in ({"limit": 0}, {"limit": 10_001}, {"offset": -1}):
        with pytest.raises(ValueError):
            ranking.page(df, [F.asc("id")], **bad)
    deep = ranking.page(df, [F.desc("id")], limit=4, offset=11, deep=10)
    assert [r["id"] for r in deep.collect()] == [13, 12, 11, 10]
    top = ranking.top_k(df, [F.desc("id")], 2, where=F.col("id") < 10, count_as="n").collect()
    assert [(r["id"], r["n"]) for r in top] == [(9, 10), (8, 10)]
    shares = ranking.share_of_max(spark.createDataFrame([(5,), (10,)], "v int"), "v", "p").collect()
    assert [r["p"] for r in shares] == [50.0, 100.0]
