"""The whole seat-planning flow in the source's own table and column names.

landing JSON -> bronze -> silver -> gold -> index, clusters, metrics -> quality
report -> relational store. Each stage writes tables and the next reads them
back, so nothing is computed twice. Stages report per-table outcomes; one
broken dataset does not stop the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatplan.functions.calendar import month_rank
from seatplan.functions.text import normalize_period
from seatplan.operators import capacity as cap
from seatplan.operators import cleaning, clusters, evaluation, index, projection, quality, reports
from seatplan.operators.snapshots import latest_per_key, latest_snapshot
from seatplan.sources import jdbc, readers, writers
from seatplan.sources.writers import Outcome

# Published resources of the open-data portal, their topics, message keys and tables.
RESOURCES = (
    readers.Resource("1d18fbc9-c0ac-458b-807f-8a4cafbf6d0e", "sby-penduduk-usia", "penduduk-usia", "sby_penduduk_usia"),
    readers.Resource("0ed9224a-ebef-4c53-ad6e-f9fd1c859747", "sby-sekolah-akreditasi", "sekolah-akreditasi", "sby_sekolah_akreditasi"),
    readers.Resource("c329aa5b-51a5-49cf-b798-9ab9946e069b", "sby-sekolah-negeri-swasta", "sekolah-negeri-swasta", "sby_sekolah_negeri_swasta"),
    readers.Resource("fc3e73a2-7a09-4593-a296-0724bbb36871", "sby-siswa-negeri-swasta", "siswa-negeri-swasta", "sby_siswa_negeri_swasta"),
    readers.Resource("22d6e3c4-b786-4443-bdfa-471b827ff717", "sby-sd-akreditasi-kecamatan", "sd-akreditasi-kecamatan", "sby_sd_akreditasi_kecamatan"),
    readers.Resource("f3028b0e-c2c4-4450-85be-b3b69af2448c", "sby-smp-akreditasi-kecamatan", "smp-akreditasi-kecamatan", "sby_smp_akreditasi_kecamatan"),
    readers.Resource("9b1f7b53-6be6-4c5b-bfb9-dd41cf16a096", "sby-sekolah-murid-guru-rasio", "sekolah-murid-guru-rasio", "sby_sekolah_murid_guru_rasio"),
)
POPULATION, REGISTRY, PUPIL_RATIO = "sby_penduduk_usia", "sby_sekolah_akreditasi", "sby_sekolah_murid_guru_rasio"
# Per-district tables with a month, and the mart their latest snapshot becomes.
PERIODIC = {
    "sby_sekolah_negeri_swasta": "sby_sekolah_per_kecamatan",
    "sby_siswa_negeri_swasta": "sby_siswa_per_kecamatan",
    "sby_sd_akreditasi_kecamatan": "sby_sd_akreditasi_summary",
    "sby_smp_akreditasi_kecamatan": "sby_smp_akreditasi_summary",
    "sby_sekolah_murid_guru_rasio": "sby_rasio_murid_guru",
}
PERIODIC_GRAIN = ("kecamatan_key", "periode_norm", "tahun")
GRAIN = {
    POPULATION: ("kecamatan_key", "nama_kelurahan", "data_bulan", "data_tahun"),
    REGISTRY: ("kode_sekolah", "tahun"),
} | dict.fromkeys(PERIODIC, PERIODIC_GRAIN)
# Rows the portal reports, columns that must be filled, number of districts.
EXPECTED_ROWS = {
    "sby_penduduk_usia": 153,
    "sby_sekolah_akreditasi": 3162,
    "sby_sekolah_negeri_swasta": 1612,
    "sby_siswa_negeri_swasta": 1643,
    "sby_sd_akreditasi_kecamatan": 1581,
    "sby_smp_akreditasi_kecamatan": 1581,
    "sby_sekolah_murid_guru_rasio": 1500,
}
REQUIRED = {
    POPULATION: ("nama_kecamatan", "nama_kelurahan", "data_tahun"),
    REGISTRY: ("kode_sekolah", "kecamatan", "kapasitas_pagu_siswa"),
} | dict.fromkeys(PERIODIC, ("kecamatan", "periode", "tahun"))
DISTRICTS = 31
BASE_YEAR, HORIZON = 2025, 5
TARGET_YEAR = BASE_YEAR + HORIZON
KEY, NAME = "kecamatan_key", "kecamatan_norm"

# Published columns of each mart, by the name the operators use.
DEMAND_COLUMNS = {
    KEY: KEY, NAME: NAME, "tahun_proyeksi": "year", "demand_sd": "demand_sd", "demand_smp": "demand_smp", "demand_total": "demand_total",
}
CAPACITY_COLUMNS = {
    KEY: KEY, NAME: NAME, "total_pagu": "seats", "total_ruang_kelas": "rooms", "total_rombel": "class_groups",
    "jumlah_sekolah": "schools", "murid_aktual": "pupils", "kapasitas": "capacity", "tahun_kapasitas": "registry_year",
}
GAP_COLUMNS = DEMAND_COLUMNS | {
    "kapasitas": "capacity", "total_pagu": "seats", "murid_aktual": "pupils", "total_ruang_kelas": "rooms",
    "jumlah_sekolah": "schools", "gap": "gap", "siswa_tak_tertampung": "unserved", "utilisasi_pct": "utilization_pct",
}
RECOMMENDATION_COLUMNS = {
    "peringkat_prioritas": "priority_rank", KEY: KEY, NAME: NAME, "tahun_target": "year", "demand_total": "demand_total",
    "kapasitas": "capacity", "siswa_tak_tertampung": "unserved", "utilisasi_pct": "utilization_pct", "jumlah_sekolah": "schools",
    "ruang_kelas_baru": "rooms_needed", "rekomendasi": "recommendation", "skor_prioritas": "priority_score",
}
INDEX_COLUMNS = {
    "scgi_rank": "index_rank", KEY: KEY, NAME: NAME, "demand_2025": "demand_base", "demand_2030": "demand_target",
    "kapasitas": "capacity", "jumlah_sekolah": "schools", "deficit_rate": "deficit_rate", "utilisasi_norm": "utilization_norm",
    "growth_rate": "growth_rate", "scgi_raw": "index_raw", "utilisasi_2030": "utilization_target", "deficit_2030": "deficit_target",
    "scgi_score": "index_score", "scgi_category": "index_category",
}
CLUSTER_COLUMNS = {
    KEY: KEY, NAME: NAME, "scgi_score": "index_score", "scgi_category": "index_category", "scgi_rank": "index_rank",
    "demand_2025": "demand_base", "demand_2030": "demand_target", "kapasitas": "capacity", "deficit_rate": "deficit_rate",
    "utilisasi_norm": "utilization_norm", "growth_rate": "growth_rate", "scgi_raw": "index_raw",
    "utilisasi_2030": "utilization_target", "deficit_2030": "deficit_target", "cluster_id": "cluster_id",
    "priority_rank": "priority_rank", "priority_label": "priority_label",
}
METRIC_COLUMNS = {
    "model": "model", "metric": "metric", "value": "value", "unit": "unit", "status": "status", "interpretasi": "meaning",
}
# CSV exports, their marts and columns.
EXPORTS = {
    "demand_proyeksi": ("gold_demand_proyeksi", tuple(DEMAND_COLUMNS)),
    "kapasitas": (
        "gold_kapasitas_kecamatan",
        (KEY, NAME, "kapasitas", "total_pagu", "murid_aktual", "total_ruang_kelas", "jumlah_sekolah"),
    ),
    "gap_analysis": (
        "gold_gap_analysis",
        (KEY, NAME, "tahun_proyeksi", "demand_total", "kapasitas", "gap", "siswa_tak_tertampung", "utilisasi_pct"),
    ),
    "rekomendasi": ("gold_rekomendasi_usb_rkb", tuple(c for c in RECOMMENDATION_COLUMNS if c != "skor_prioritas")),
    "scgi": ("gold_school_capacity_gap_index", tuple(INDEX_COLUMNS)),
    "clusters": ("gold_cluster_priority", tuple(CLUSTER_COLUMNS)),
    "mape_detail": ("mape_detail", (KEY, "projected_murid", "actual_murid", "ape")),
    "elbow_data": ("elbow_data", ("k", "inertia")),
    "evaluation": ("gold_evaluation_metrics", (*METRIC_COLUMNS, "_generated_at")),
}
# What the serving store's tables hold, where that is less than the mart does.
_PERIOD_COLUMNS = ("tahun", "periode", "periode_norm")
SERVED_COLUMNS = {
    "gold_demand_proyeksi": tuple(DEMAND_COLUMNS),
    "gold_kapasitas_kecamatan": tuple(CAPACITY_COLUMNS),
    "gold_gap_analysis": EXPORTS["gap_analysis"][1],
    "gold_rekomendasi_usb_rkb": tuple(RECOMMENDATION_COLUMNS),
    "gold_school_capacity_gap_index": tuple(INDEX_COLUMNS),
    "gold_cluster_priority": tuple(CLUSTER_COLUMNS),
    "gold_evaluation_metrics": tuple(METRIC_COLUMNS),
    "gold_data_quality_report": quality.REPORT_COLUMNS,
    "sby_sekolah_per_kecamatan": (KEY, NAME, "sekolah_negeri", "sekolah_swasta", "total_sekolah", *_PERIOD_COLUMNS),
    "sby_siswa_per_kecamatan": (KEY, NAME, "siswa_negeri", "siswa_swasta", "total_siswa", *_PERIOD_COLUMNS),
    "sby_sd_akreditasi_summary": (KEY, NAME, "akreditasi_a", "akreditasi_b", "akreditasi_c", "belum_akreditasi", "total_sekolah", *_PERIOD_COLUMNS),
    "sby_smp_akreditasi_summary": (KEY, NAME, "akreditasi_a", "akreditasi_b", "akreditasi_c", "belum_akreditasi", "total_sekolah", *_PERIOD_COLUMNS),
    "sby_rasio_murid_guru": (KEY, NAME, *[f"{s}_{c}" for s in ("sd", "smp", "mi", "mts") for c in ("murid", "guru", "rasio")], *_PERIOD_COLUMNS),
    "sby_penduduk_usia_summary": (KEY, NAME, *[f"usia_{i}" for i in range(16)]),
}
# Tables of the serving store.
PUBLISHED_TABLES = (
    "gold_demand_proyeksi", "gold_kapasitas_kecamatan", "gold_gap_analysis", "gold_rekomendasi_usb_rkb",
    "gold_school_capacity_gap_index", "gold_cluster_priority", "gold_evaluation_metrics", "gold_data_quality_report",
    "sby_sekolah_per_kecamatan", "sby_siswa_per_kecamatan", "sby_sd_akreditasi_summary", "sby_smp_akreditasi_summary",
    "sby_rasio_murid_guru", "sby_penduduk_usia_summary",
)


@dataclass(frozen=True)
class SeatPlan:
    """The flow over one lakehouse root; ``run_at`` is one fixed time for all stamps."""

    spark: SparkSession
    root: str
    run_at: Column | None = None

    def _now(self) -> Column:
        return self.run_at if self.run_at is not None else F.current_timestamp()

    def read(self, layer: str, table: str) -> DataFrame:
        return readers.read_table(self.spark, f"{self.root}/{layer}", table)

    def _write_gold(self, df: DataFrame, table: str, stamp: str = "_gold_created_at") -> Outcome:
        return writers.write_counted(df.withColumn(stamp, self._now()), f"{self.root}/gold", table)

    # --- bronze and silver -------------------------------------------------------------------

    def bronze(self, landing: str, schemas: Mapping[str, str] | None = None) -> list[Outcome]:
        """Landing folders (one per message key) as tables with lineage."""

        def ingest(resource: readers.Resource) -> Outcome:
            raw = readers.read_json_array(self.spark, f"{landing}/{resource.key}", (schemas or {}).get(resource.table))
            stamped = readers.with_lineage(raw, resource.key.replace("-", "_"), run_at=self._now())
            return writers.write_counted(stamped, f"{self.root}/bronze", resource.table, source=raw)

        return writers.each_isolated({r.table: (lambda r=r: ingest(r)) for r in RESOURCES})

    def silver(self, order: Sequence[str] = ("ingested_at", "_ingested_at")) -> list[Outcome]:
        """Trimmed, keyed, one row per grain: the row that arrived last."""

        def clean(table: str) -> Outcome:
            raw = self.read("bronze", table)
            name = "nama_kecamatan" if table == POPULATION else "kecamatan"
            keyed = cleaning.add_keys(cleaning.trim_strings(raw), name, "periode" if table in PERIODIC else None)
            by = [c for c in order if c in keyed.columns]
            once = cleaning.one_per_grain(keyed, GRAIN[table], by, keep="last")
            stamped = once.withColumn("_processed_at", self._now())
            # readers ask the registry for its latest year only: let them skip the other folders
            folders = ("tahun",) if table == REGISTRY else ()
            return writers.write_counted(stamped, f"{self.root}/silver", table, source=raw, partition_by=folders)

        return writers.each_isolated({t: (lambda t=t: clean(t)) for t in GRAIN})

    # --- gold --------------------------------------------------------------------------------

    def snapshots(self) -> list[Outcome]:
        def build(source: str, mart: str) -> Outcome:
            return self._write_gold(latest_snapshot(self.read("silver", source), KEY, "tahun", "periode_norm"), mart)

        jobs = {mart: (lambda s=s, mart=mart: build(s, mart)) for s, mart in PERIODIC.items()}
        jobs["sby_penduduk_usia_summary"] = lambda: self._write_gold(self.age_vector(), "sby_penduduk_usia_summary")
        return writers.each_isolated(jobs)

    def age_vector(self, every_snapshot: bool = False) -> DataFrame:
        """People by age; each sub-district counts once, with its newest month."""
        people = self.read("silver", POPULATION)
        if not every_snapshot:
            recency = [F.col("data_tahun").try_cast("int"), _month(F.col("data_bulan"))]
            people = latest_per_key(people, [KEY, "nama_kelurahan"], recency)
        return projection.age_vector_from_wide(people, KEY, NAME)

    def demand(self) -> Outcome:
        ages = self.read("gold", "sby_penduduk_usia_summary")
        years = projection.cohort_projection(ages, [KEY, NAME], BASE_YEAR, HORIZON)
        return self._write_gold(_publish(years, DEMAND_COLUMNS), "gold_demand_proyeksi")

    def capacity(self, keep_blank_keys: bool = False) -> Outcome:
        totals = {"seats": "kapasitas_pagu_siswa", "rooms": "jumlah_ruang_kelas", "class_groups": "jumlah_rombel"}
        registry = cap.registry_totals(
            self.read("silver", REGISTRY), KEY, "tahun", totals, name=NAME, keep_blank_keys=keep_blank_keys
        )
        pupils = cap.pupils_served(self.read("gold", PERIODIC[PUPIL_RATIO]), KEY)
        audited = cap.capacity_floor(registry, pupils, KEY)
        return self._write_gold(_publish(audited, CAPACITY_COLUMNS), "gold_kapasitas_kecamatan")

    def gap(self) -> Outcome:
        demand = _canonical(self.read("gold", "gold_demand_proyeksi"), DEMAND_COLUMNS)
        audited = _canonical(self.read("gold", "gold_kapasitas_kecamatan"), CAPACITY_COLUMNS)
        return self._write_gold(_publish(cap.demand_gap(demand, audited, KEY), GAP_COLUMNS), "gold_gap_analysis")

    def _gap(self) -> DataFrame:
        known = self.read("gold", "gold_kapasitas_kecamatan").select(KEY, F.lit(True).alias("capacity_known"))
        rows = _canonical(self.read("gold", "gold_gap_analysis"), GAP_COLUMNS).join(known, KEY, "left")
        return rows.withColumn("capacity_known", F.coalesce("capacity_known", F.lit(False)))

    def recommendation(self) -> Outcome:
        decided = cap.recommend(_canonical(self.read("gold", "gold_gap_analysis"), GAP_COLUMNS), KEY, TARGET_YEAR)
        return self._write_gold(_publish(decided, RECOMMENDATION_COLUMNS), "gold_rekomendasi_usb_rkb")

    def maximum(self) -> list[Outcome]:
        """The greatest capacity, the schools that have it, and that capacity plus a fifth."""
        registry, seats = self.read("bronze", REGISTRY), "kapasitas_pagu_siswa"
        columns = [c for c in ("kode_sekolah", "nama_sekolah", "kecamatan", "kelurahan", "tipe_sekolah", "status_sekolah") if c in registry.columns]
        at_top = reports.at_maximum(registry, seats, [*columns, seats], "max_kapasitas_pagu_siswa")
        top = registry.agg(F.max(seats).alias("max_kapasitas_pagu_siswa")).withColumn("_silver_created_at", self._now())
        plus = reports.maximum_plus(registry, seats, 1.2, "max_kapasitas_pagu_siswa", "max_kapasitas_plus_20_percent")
        return writers.each_isolated(
            {
                "sby_max_kapasitas": lambda: writers.write_counted(top, f"{self.root}/silver", "sby_max_kapasitas"),
                "sby_max_kapasitas_detail": lambda: writers.write_counted(
                    at_top.withColumn("_bronze_processed_at", self._now()), f"{self.root}/silver", "sby_max_kapasitas_detail"
                ),
                "sby_max_kapasitas_plus_20": lambda: self._write_gold(plus, "sby_max_kapasitas_plus_20"),
            }
        )

    def gold(self) -> list[Outcome]:
        done = self.snapshots()
        for table, step in (
            ("gold_demand_proyeksi", self.demand), ("gold_kapasitas_kecamatan", self.capacity),
            ("gold_gap_analysis", self.gap), ("gold_rekomendasi_usb_rkb", self.recommendation),
        ):
            done += writers.each_isolated({table: step})
        return done + self.maximum()

    # --- index, clusters, metrics ------------------------------------------------------------

    def gap_index(self) -> Outcome:
        scored = index.gap_index(index.index_inputs(self._gap(), KEY, BASE_YEAR, TARGET_YEAR, NAME), KEY)
        return self._write_gold(_publish(scored, INDEX_COLUMNS), "gold_school_capacity_gap_index")

    def _mape_detail(self) -> Outcome:
        demand = _canonical(self.read("gold", "gold_demand_proyeksi"), DEMAND_COLUMNS)
        actual = evaluation.actual_pupils(self.read("gold", PERIODIC[PUPIL_RATIO]), KEY)
        detail = evaluation.absolute_percentage_error(demand, actual, KEY, BASE_YEAR)
        names = {KEY: KEY, "projected_murid": "projected", "actual_murid": "actual", "ape": "ape"}
        return writers.write_counted(_publish(detail, names), f"{self.root}/gold", "mape_detail")

    def analysis(self, k: int = 4, elbow: Sequence[int] = range(2, 9)) -> list[Outcome]:
        done = writers.each_isolated({"mape_detail": self._mape_detail, "gold_school_capacity_gap_index": self.gap_index})
        return done + writers.each_isolated({"gold_cluster_priority": lambda: self._cluster(k, elbow)})

    def _cluster(self, k: int, elbow: Sequence[int]) -> Outcome:
        scored = _canonical(self.read("gold", "gold_school_capacity_gap_index"), INDEX_COLUMNS)
        scaled = clusters.scale_vector(clusters.assemble(clusters.steady_order(scored, KEY))).select("features")
        writers.overwrite_table(clusters.elbow_sweep(scaled, elbow), f"{self.root}/gold", "elbow_data")
        grouped = clusters.cluster_districts(scored, KEY, k=k).withColumn("x", vector_to_array("features"))
        writers.overwrite_table(grouped.drop("features"), f"{self.root}/gold", "_clustered")
        settled = self.read("gold", "_clustered")
        done = self._write_gold(_publish(settled, CLUSTER_COLUMNS), "gold_cluster_priority")
        metrics = evaluation.metric_table(
            evaluation.mean_error(self.read("gold", "mape_detail")),
            clusters.silhouette_score(settled, "x", "cluster_id", known=k).withColumn("silhouette", F.round("silhouette", 4)),
            clusters.davies_bouldin(settled, "x", "cluster_id", known=k, alone=None),
        )
        self._write_gold(_publish(metrics, METRIC_COLUMNS), "gold_evaluation_metrics", "_generated_at")
        return done

    # --- quality, export, publish ------------------------------------------------------------

    def quality_report(self) -> Outcome:
        q, spark, parts = quality, self.spark, []

        def bronze(t: str) -> DataFrame:
            df = self.read("bronze", t)
            return q.run_checks(df, t, "bronze", [q.row_count(EXPECTED_ROWS[t]), *[q.completeness(c) for c in REQUIRED[t] if c in df.columns]])

        def consistent(t: str) -> DataFrame:
            checks = [q.key_consistency("kecamatan", NAME, KEY, DISTRICTS), q.period_consistency("periode", "periode_norm")]
            return q.run_checks(self.read("silver", t), t, "silver", checks)

        def unique(t: str) -> DataFrame:
            return q.uniqueness(self.read("silver", t), t, "silver", PERIODIC_GRAIN, q.GRAIN_METRIC)

        def seats() -> DataFrame:
            c = "kapasitas_pagu_siswa"
            checks = [q.not_negative(c, "kapasitas_pagu_negatif"), q.not_null(c, "kapasitas_pagu_null")]
            return q.run_checks(self.read("silver", REGISTRY), REGISTRY, "silver", checks)

        def ratio_type() -> DataFrame:
            return q.column_type(
                self.read("silver", PUPIL_RATIO), "mts_rasio", PUPIL_RATIO, "silver", "mts_rasio_dtype", q.RATIO_NOTE
            )

        def joinable() -> DataFrame:
            return q.joinability(
                self.read("silver", POPULATION), self.read("silver", REGISTRY), KEY, "penduduk x akreditasi", "silver",
                q.MATCH_METRIC, q.MATCH_NOTE,
            )

        def add(build, table: str, layer: str, dimension: str, metric: str) -> None:
            parts.append(q.settled(spark, build, table, layer, dimension, metric))

        for t in EXPECTED_ROWS:
            add(lambda t=t: bronze(t), t, "bronze", "reconciliation", q.ROW_COUNT_METRIC)
        for t in PERIODIC:
            add(lambda t=t: consistent(t), t, "silver", "consistency", "kecamatan")
        for t in PERIODIC:
            add(lambda t=t: unique(t), t, "silver", "uniqueness", "grain")
        add(seats, REGISTRY, "silver", "validity", "kapasitas")
        add(ratio_type, PUPIL_RATIO, "silver", "validity", "mts_rasio")
        add(joinable, "penduduk x akreditasi", "silver", "joinability", "match")
        return self._write_gold(q.assemble_report(parts), "gold_data_quality_report", "_generated_at")

    def export(self, folder: str) -> list[Outcome]:
        def one(name: str) -> Outcome:
            table, columns = EXPORTS[name]
            writers.export_csv(self.read("gold", table), f"{folder}/{name}", columns)
            return Outcome(name)

        return writers.each_isolated({n: (lambda n=n: one(n)) for n in EXPORTS})

    def served(self, table: str) -> DataFrame:
        """A mart as the serving store holds it: its columns alone, without time stamps.

        A column that the landed data lack is left out; the store fills it with NULL.
        """
        mart = self.read("gold", table)
        return mart.select(*[F.col(f"`{c}`") for c in SERVED_COLUMNS[table] if c in mart.columns])

    def publish(self, url: str, **login: str) -> list[Outcome]:
        def one(table: str) -> Outcome:
            return jdbc.publish(self.served(table), url, table, **login)

        return writers.each_isolated({t: (lambda t=t: one(t)) for t in PUBLISHED_TABLES})

    def run(self, landing: str, schemas: Mapping[str, str] | None = None) -> list[Outcome]:
        done = self.bronze(landing, schemas) + self.silver() + self.gold() + self.analysis()
        return done + writers.each_isolated({"gold_data_quality_report": self.quality_report})


def _month(value: Column) -> Column:
    """Months as numbers, whether written as numbers or as names."""
    return F.coalesce(value.try_cast("int"), month_rank(normalize_period(value.cast("string"))))


def _publish(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(inner).alias(outer) for outer, inner in columns.items()])


def _canonical(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(outer).alias(inner) for outer, inner in columns.items()])
