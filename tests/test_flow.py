"""The whole flow over small landed files, against numbers worked out by hand or brute force."""

import json
import random

import pytest
from conftest import as_dicts

from seatplan.operators.projection import AGE_WORDS
from seatplan.plans.school_seats import POPULATION, PUPIL_RATIO, REGISTRY, RESOURCES, SeatPlan

DISTRICTS = ["Asem Rowo", "Benowo", "Bubutan", "Bulak", "Dukuh Pakis", "Gayungan"]
SPELLINGS = [lambda d: f"Kec. {d}", lambda d: f"  {d.upper()} ", lambda d: d.replace(" ", "  ")]


def key(d):
    return d.upper().replace(" ", "")


def stamp(hour):
    return {"source_resource_id": "r", "ingested_at": f"2026-01-01 {hour:02}:00:00"}


def landed(tmp_path):
    rng = random.Random(11)
    people, schools, ratio = [], [], []
    for i, d in enumerate(DISTRICTS):
        for s in range(2):
            row = {"nama_kecamatan": SPELLINGS[s](d), "nama_kelurahan": f"K{s}", "data_bulan": "3", "data_tahun": "2025"}
            for w in AGE_WORDS:
                row |= {f"{w}_laki": rng.randrange(40), f"{w}_perempuan": rng.choice([None, rng.randrange(40)])}
            people.append(row | stamp(1))
        for n in range(i):  # the first district has no school
            schools.append({"kode_sekolah": f"S{i}{n}", "nama_sekolah": "s", "kecamatan": SPELLINGS[n % 3](d), "tahun": 2024,
                            "kapasitas_pagu_siswa": 60 * n if n else None, "jumlah_ruang_kelas": n, "jumlah_rombel": n} | stamp(1))
            schools.append({"kode_sekolah": f"S{i}{n}", "nama_sekolah": "s", "kecamatan": d, "tahun": 2023,
                            "kapasitas_pagu_siswa": 9999, "jumlah_ruang_kelas": 9, "jumlah_rombel": 9} | stamp(1))
        for month, amount in (("desember", 50 + 90 * i), ("APRIL", 1)):
            ratio.append({"kecamatan": SPELLINGS[i % 3](d), "periode": f" {month} ", "tahun": 2024, "sd_murid": amount, "smp_murid": 2 * amount,
                          "mi_murid": None, "mts_murid": 7, "mts_rasio": "-"} | stamp(1))
    # a later re-publish of everything, with one corrected value
    again = [r | stamp(2) for r in ratio]
    again[0] = again[0] | {"sd_murid": 55}
    data = {POPULATION: people * 2, REGISTRY: schools, PUPIL_RATIO: ratio + again}
    plain = [{k: r[k] for k in ("kecamatan", "periode", "tahun", "ingested_at", "source_resource_id")} | {"total": 1} for r in ratio]
    for r in RESOURCES:
        if r.table == "sby_smp_akreditasi_kecamatan":
            continue  # this dataset never arrived
        folder = tmp_path / "landing" / r.key
        folder.mkdir(parents=True)
        rows = data.get(r.table, plain)
        (folder / "a.json").write_text(json.dumps(rows[: len(rows) // 2], indent=1))
        (folder / "b.json").write_text(json.dumps(rows[len(rows) // 2 :]))
    return people, schools, ratio


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("flow")
    inputs = landed(tmp)
    plan = SeatPlan(spark, str(tmp / "lake"))
    outcomes = plan.run(str(tmp / "landing"))
    return plan, inputs, {o.table: o for o in outcomes}, outcomes, tmp


def test_only_the_missing_dataset_fails(flow):
    _, _, _, outcomes, _ = flow
    failed = {o.table for o in outcomes if o.error}
    assert failed == {"sby_smp_akreditasi_kecamatan", "sby_smp_akreditasi_summary"}


def test_silver_has_one_row_per_grain_and_the_last_arrival_wins(flow):
    plan, (_, _, ratio), _, _, _ = flow
    rows = plan.read("silver", PUPIL_RATIO)
    assert rows.count() == len(ratio)
    row = rows.where("kecamatan_key = 'ASEMROWO' AND periode_norm = 'Desember'").first()
    assert (row["sd_murid"], row["kecamatan"], row["kecamatan_norm"]) == (55, "Kec. Asem Rowo", "ASEM ROWO")


def people_at(people, d, ages):
    total = 0
    for r in people:
        if key(r["nama_kecamatan"].replace("Kec. ", "").strip()) == key(d):
            total += sum((r[f"{AGE_WORDS[a]}_{s}"] or 0) for a in ages for s in ("laki", "perempuan"))
    return total


def test_demand(flow):
    plan, (people, _, _), _, _, _ = flow
    got = {(r["kecamatan_key"], r["tahun_proyeksi"]): r for r in plan.read("gold", "gold_demand_proyeksi").collect()}
    assert len(got) == len(DISTRICTS) * 6
    for d in DISTRICTS:
        for k in range(6):
            row = got[(key(d), 2025 + k)]
            assert row["demand_sd"] == people_at(people, d, range(7 - k, 13 - k))
            assert row["demand_smp"] == people_at(people, d, range(13 - k, 16 - k))


def test_capacity_and_gap(flow):
    plan, _, _, _, _ = flow
    caps = as_dicts(plan.read("gold", "gold_kapasitas_kecamatan"), "kecamatan_key")
    assert set(caps) == {key(d) for d in DISTRICTS[1:]}
    for i, d in enumerate(DISTRICTS[1:], start=1):
        row, pupils = caps[key(d)], 3 * (50 + 90 * i) + 7
        seats = sum(60 * n for n in range(i))
        assert (row["total_pagu"], row["murid_aktual"], row["kapasitas"]) == (seats, pupils, max(seats, pupils))
        assert (row["jumlah_sekolah"], row["tahun_kapasitas"]) == (i, 2024)
    for r in plan.read("gold", "gold_gap_analysis").collect():
        assert r["gap"] == r["demand_total"] - r["kapasitas"]
        assert r["siswa_tak_tertampung"] == max(0, r["gap"])
        assert (r["utilisasi_pct"] is None) == (r["kapasitas"] == 0)


def test_recommendation(flow):
    plan, _, _, _, _ = flow
    rows = plan.read("gold", "gold_rekomendasi_usb_rkb").orderBy("peringkat_prioritas").collect()
    assert [r["peringkat_prioritas"] for r in rows] == list(range(1, len(DISTRICTS) + 1))
    assert [r["siswa_tak_tertampung"] for r in rows] == sorted((r["siswa_tak_tertampung"] for r in rows), reverse=True)
    for r in rows:
        assert r["ruang_kelas_baru"] == -(-r["siswa_tak_tertampung"] // 32)
    no_school = [r for r in rows if r["kecamatan_key"] == "ASEMROWO"][0]
    assert (no_school["jumlah_sekolah"], no_school["rekomendasi"]) == (None, "USB")


def test_index_clusters_and_metrics(flow):
    plan, _, _, _, _ = flow
    scored = as_dicts(plan.read("gold", "gold_school_capacity_gap_index"), "kecamatan_key")
    assert set(scored) == {key(d) for d in DISTRICTS[1:]}  # capacity is needed
    for r in scored.values():
        assert r["scgi_raw"] == pytest.approx(0.5 * r["deficit_rate"] + 0.3 * r["utilisasi_norm"] + 0.2 * r["growth_rate"])
    clustered = plan.read("gold", "gold_cluster_priority").collect()
    assert len(clustered) == len(scored) and {r["priority_rank"] for r in clustered} <= {1, 2, 3, 4}
    detail = plan.read("gold", "mape_detail").collect()
    assert all(r["ape"] == pytest.approx(abs(r["projected_murid"] - r["actual_murid"]) / r["actual_murid"] * 100) for r in detail)
    metrics = as_dicts(plan.read("gold", "gold_evaluation_metrics"), "metric")
    assert metrics["MAPE"]["value"] == pytest.approx(sum(r["ape"] for r in detail) / len(detail), abs=0.005)
    assert set(metrics) == {"MAPE", "Silhouette_Score", "Davies_Bouldin_Index"}
    assert plan.read("gold", "elbow_data").count() == 7


def test_maximum(flow):
    plan, (_, schools, _), _, _, _ = flow
    assert [c for c in plan.read("silver", "sby_max_kapasitas").columns] == ["max_kapasitas_pagu_siswa", "_silver_created_at"]
    assert [r["max_kapasitas_pagu_siswa"] for r in plan.read("silver", "sby_max_kapasitas").collect()] == [9999]
    assert plan.read("silver", "sby_max_kapasitas_detail").count() == len(schools) // 2
    row = plan.read("gold", "sby_max_kapasitas_plus_20").first()
    assert (row["max_kapasitas_pagu_siswa"], row["max_kapasitas_plus_20_percent"]) == (9999, pytest.approx(9999 * 1.2))


def test_quality_report(flow):
    plan, _, _, _, _ = flow
    report = plan.read("gold", "gold_data_quality_report").collect()
    failed = {(r["table"], r["dimension"]) for r in report if r["value"] == "ERROR"}
    assert failed == {("sby_smp_akreditasi_kecamatan", d) for d in ("reconciliation", "consistency", "uniqueness")}
    dup = [r for r in report if r["dimension"] == "uniqueness" and r["value"] != "ERROR"]
    assert dup and all(r["value"] == "0" and r["status"] == "PASS" for r in dup)
    assert [r["value"] for r in report if r["dimension"] == "joinability"] == ["5/6"]
    assert [r["status"] for r in report if r["metric"] == "mts_rasio_dtype"] == ["WARN"]


def test_exports_and_publishing_isolate_failures(flow):
    plan, _, _, _, tmp = flow
    done = plan.export(str(tmp / "csv"))
    assert [o.error for o in done] == [None] * 9
    head = plan.spark.read.csv(str(tmp / "csv" / "clusters"), header=True).columns
    assert head[:3] == ["kecamatan_key", "kecamatan_norm", "scgi_score"]
    # no driver for such a store exists here: every table reports its own failure
    gaps = plan.served("gold_gap_analysis").columns
    assert gaps[-1] == "utilisasi_pct" and not {"total_pagu", "murid_aktual", "_gold_created_at"} & set(gaps)
    published = plan.publish("jdbc:nowhere://x", user="u")
    assert len(published) == 14 and all(o.error for o in published)
