"""School data out of the driver tables.

district = nation, sub-district = customer, people = orders, age = customer % 16,
school = supplier, registry year = shipping year, seats = account balance / 50,
pupils = 12 x the orders of the last complete month, split over four levels by
order number. Raw names are dirtied on purpose so that cleaning has work to do.

Everything is derived in Spark from the whole tables; ``SQL`` holds the same
derivations as CTEs for the DuckDB side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatplan.functions.calendar import MONTHS
from seatplan.operators import capacity as cap
from seatplan.operators import evaluation, index, projection
from seatplan.operators.cleaning import add_keys
from seatplan.operators.snapshots import latest_snapshot

BASE_YEAR, HORIZON = 2025, 5
TARGET_YEAR = BASE_YEAR + HORIZON
KEY, NAME, PERIOD = "district_key", "district_name", "period_norm"


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table under its known schema, so that no job has to look for one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def dirty_name(name: str, seed: str) -> Column:
    return F.expr(
        f"""CASE ({seed}) % 4 WHEN 0 THEN concat('Kec. ', {name}) WHEN 1 THEN concat('kel.', lower({name}))
        WHEN 2 THEN concat('  ', replace({name}, '_', '  _')) ELSE {name} END"""
    )


def dirty_period(month: str) -> Column:
    name = f"array({', '.join(repr(m) for m in MONTHS)})[{month} - 1]"
    return F.expr(
        f"CASE {month} % 3 WHEN 0 THEN concat(' ', upper({name})) WHEN 1 THEN concat(lower({name}), '  ') ELSE {name} END"
    )


def keyed(df: DataFrame, period: str | None = None) -> DataFrame:
    return add_keys(df, "kecamatan", period, norm_as=NAME, key_as=KEY, period_as=PERIOD)


def nations(spark: SparkSession, sf: str, key: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias(key), "n_name")


def population_raw(spark: SparkSession, sf: str) -> DataFrame:
    """(kecamatan, age, people) per customer.

    Orders are counted per customer before the join: the count is combined map
    side, so a customer with a third of all orders is one row per partition, and
    the join reuses the count's partitioning.
    """
    people = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("people"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        people.join(customer, "o_custkey")
        .join(nations(spark, sf, "c_nationkey"), "c_nationkey")
        .select(
            F.col("o_custkey").alias("kelurahan"),
            dirty_name("n_name", "o_custkey").alias("kecamatan"),
            F.expr("CAST(o_custkey % 16 AS INT) AS age"),
            "people",
        )
    )


def population(spark: SparkSession, sf: str) -> DataFrame:
    return keyed(population_raw(spark, sf))


def age_vector(spark: SparkSession, sf: str) -> DataFrame:
    return projection.age_vector_from_long(population(spark, sf), KEY, "age", "people", NAME)


def demand(spark: SparkSession, sf: str) -> DataFrame:
    return projection.cohort_projection(age_vector(spark, sf), [KEY, NAME], BASE_YEAR, HORIZON)


def registry_raw(spark: SparkSession, sf: str) -> DataFrame:
    """(kode_sekolah, kecamatan, tahun, seats, rooms, class groups): suppliers that shipped in a year."""
    shipped = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("kode_sekolah"), F.year("l_shipdate").alias("tahun"))
        .agg(F.lit(1).alias("_one")).drop("_one")
    )
    supplier = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS kode_sekolah", "s_nationkey", "greatest(0L, floor(s_acctbal / 50)) AS kapasitas_pagu_siswa"
    )
    return (
        shipped.join(supplier, "kode_sekolah")
        .join(nations(spark, sf, "s_nationkey"), "s_nationkey")
        .select(
            "kode_sekolah",
            dirty_name("n_name", "kode_sekolah").alias("kecamatan"),
            "tahun",
            "kapasitas_pagu_siswa",
            F.expr("kapasitas_pagu_siswa div 32 AS jumlah_ruang_kelas"),
            F.expr("kapasitas_pagu_siswa div 28 AS jumlah_rombel"),
        )
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return keyed(registry_raw(spark, sf))


def pupil_fact_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Pupils per district, month and year at four levels.

    Orders collapse per customer and month before they meet the customers.
    """
    monthly = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("tahun"), F.month("o_orderdate").alias("_month"))
        .agg(*[F.expr(f"count_if(o_orderkey % 4 = {i}) AS {c}") for i, c in enumerate(cap.LEVELS)])
    )
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        monthly.join(customer, "o_custkey")
        .groupBy("c_nationkey", "tahun", "_month")
        .agg(*[F.expr(f"12 * sum({c}) AS {c}") for c in cap.LEVELS])
        .join(nations(spark, sf, "c_nationkey"), "c_nationkey")
        .select(
            dirty_name("n_name", "c_nationkey + _month").alias("kecamatan"),
            dirty_period("_month").alias("periode"),
            "tahun",
            *cap.LEVELS,
            F.expr("CASE WHEN _month % 5 = 0 THEN '-' ELSE CAST(mts_murid AS STRING) END AS mts_rasio"),
        )
    )


def pupil_fact(spark: SparkSession, sf: str) -> DataFrame:
    return keyed(pupil_fact_raw(spark, sf), "periode")


def latest_pupils(spark: SparkSession, sf: str) -> DataFrame:
    return latest_snapshot(pupil_fact(spark, sf), KEY, "tahun", PERIOD)


def registry_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cap.registry_totals(
        registry(spark, sf), KEY, "tahun",
        {"seats": "kapasitas_pagu_siswa", "rooms": "jumlah_ruang_kelas", "class_groups": "jumlah_rombel"}, name=NAME,
    )


def capacity(spark: SparkSession, sf: str) -> DataFrame:
    return cap.capacity_floor(registry_totals(spark, sf), cap.pupils_served(latest_pupils(spark, sf), KEY), KEY)


def seats_only(spark: SparkSession, sf: str) -> DataFrame:
    """Capacity by registered seats alone; keeps the gap two-sided at every scale."""
    totals = registry_totals(spark, sf)
    return totals.withColumns({"capacity": F.col("seats"), "pupils": F.lit(0).cast("long")})


def gap(spark: SparkSession, sf: str) -> DataFrame:
    return cap.demand_gap(demand(spark, sf), capacity(spark, sf), KEY)


def gap_by_seats(spark: SparkSession, sf: str) -> DataFrame:
    return cap.demand_gap(demand(spark, sf), seats_only(spark, sf), KEY)


def recommendation(spark: SparkSession, sf: str) -> DataFrame:
    return cap.recommend(gap_by_seats(spark, sf), KEY, TARGET_YEAR)


def gap_index(spark: SparkSession, sf: str) -> DataFrame:
    inputs = index.index_inputs(gap_by_seats(spark, sf), KEY, BASE_YEAR, TARGET_YEAR, NAME)
    return index.gap_index(inputs, KEY)


def ape_detail(spark: SparkSession, sf: str) -> DataFrame:
    actual = evaluation.actual_pupils(latest_pupils(spark, sf), KEY)
    return evaluation.absolute_percentage_error(demand(spark, sf), actual, KEY, BASE_YEAR)


def located(df: DataFrame) -> DataFrame:
    """Coordinates made from the district number."""
    n = f"CAST(split_part({KEY}, '_', 2) AS INT)"
    return df.selectExpr(
        "*", f"-7.2D - ({n} % 5) * 0.03D - {n} * 0.001D AS latitude", f"112.6D + ({n} * 7 % 25) * 0.01D AS longitude"
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """district_key -> region name."""
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return table(spark, sf, "nation").join(region, "n_regionkey").select(
        F.col("n_name").alias(KEY), F.col("r_name").alias("region")
    )


# --- the same in SQL -------------------------------------------------------------------------


def _dirty(name: str, seed: str) -> str:
    return (
        f"CASE ({seed}) % 4 WHEN 0 THEN 'Kec. ' || {name} WHEN 1 THEN 'kel.' || lower({name}) "
        f"WHEN 2 THEN '  ' || replace({name}, '_', '  _') ELSE {name} END"
    )


def sql_norm(c: str) -> str:
    return rf"upper(trim(regexp_replace(regexp_replace({c}, '(?i)^\s*(?:kec|kel)\.', ''), '\s+', ' ', 'g')))"


def sql_key(c: str) -> str:
    return rf"regexp_replace({sql_norm(c)}, '\s+', '', 'g')"


def sql_period(c: str) -> str:
    return f"upper(substr(trim({c}), 1, 1)) || lower(substr(trim({c}), 2))"


def sql_round(x: str, digits: int) -> str:
    """Half-up rounding of the number as written, like Spark's."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
_LEVEL_COUNTS = ", ".join(
    f"CAST(12 * count(*) FILTER (o_orderkey % 4 = {i}) AS BIGINT) AS {c}" for i, c in enumerate(cap.LEVELS)
)
_LEVEL_COLS = ", ".join(cap.LEVELS)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "pop_raw": (
        (),
        f"""SELECT c_custkey AS kelurahan, {_dirty('n_name', 'c_custkey')} AS kecamatan,
            CAST(c_custkey % 16 AS INTEGER) AS age, count(*) AS people
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
        GROUP BY c_custkey, n_name""",
    ),
    "pop": (
        ("pop_raw",),
        f"SELECT *, {sql_norm('kecamatan')} AS district_name, {sql_key('kecamatan')} AS district_key FROM pop_raw",
    ),
    "vec": (
        ("pop",),
        "SELECT district_key, min(district_name) AS district_name, "
        + ", ".join(f"CAST(coalesce(sum(people) FILTER (age = {a}), 0) AS BIGINT) AS usia_{a}" for a in range(16))
        + " FROM pop GROUP BY district_key",
    ),
    "proj": (
        ("pop",),
        f"""SELECT district_key, min(district_name) AS district_name, CAST({BASE_YEAR} + k AS INTEGER) AS year,
            CAST(sum(CASE WHEN age + k BETWEEN 7 AND 12 THEN people ELSE 0 END) AS BIGINT) AS demand_sd,
            CAST(sum(CASE WHEN age + k BETWEEN 13 AND 15 THEN people ELSE 0 END) AS BIGINT) AS demand_smp,
            CAST(sum(CASE WHEN age + k BETWEEN 7 AND 15 THEN people ELSE 0 END) AS BIGINT) AS demand_total
        FROM pop CROSS JOIN (SELECT unnest(range(0, {HORIZON + 1})) AS k) GROUP BY district_key, k""",
    ),
    "reg_raw": (
        (),
        f"""SELECT l_suppkey AS kode_sekolah, {_dirty('n_name', 'l_suppkey')} AS kecamatan, tahun,
            pagu AS kapasitas_pagu_siswa, pagu // 32 AS jumlah_ruang_kelas, pagu // 28 AS jumlah_rombel
        FROM (SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS tahun FROM lineitem)
        JOIN (SELECT *, CAST(greatest(0, floor(s_acctbal / 50)) AS BIGINT) AS pagu FROM supplier) ON l_suppkey = s_suppkey
        JOIN nation ON n_nationkey = s_nationkey""",
    ),
    "reg": (
        ("reg_raw",),
        f"SELECT *, {sql_norm('kecamatan')} AS district_name, {sql_key('kecamatan')} AS district_key FROM reg_raw",
    ),
    "fact_raw": (
        (),
        f"""SELECT {_dirty('n_name', 'n_nationkey + m')} AS kecamatan,
            CASE m % 3 WHEN 0 THEN ' ' || upper({_MONTH_LIST}[m]) WHEN 1 THEN lower({_MONTH_LIST}[m]) || '  '
                 ELSE {_MONTH_LIST}[m] END AS periode,
            tahun, {_LEVEL_COLS}, CASE WHEN m % 5 = 0 THEN '-' ELSE CAST(mts_murid AS VARCHAR) END AS mts_rasio
        FROM (SELECT n_name, n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS tahun,
                CAST(month(o_orderdate) AS INTEGER) AS m, {_LEVEL_COUNTS}
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
            GROUP BY ALL)""",
    ),
    "fact": (
        ("fact_raw",),
        f"""SELECT *, {sql_norm('kecamatan')} AS district_name, {sql_key('kecamatan')} AS district_key,
            {sql_period('periode')} AS period_norm FROM fact_raw""",
    ),
    "latest": (
        ("fact",),
        f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY district_key
            ORDER BY tahun DESC NULLS LAST, list_position({_MONTH_LIST}, period_norm) DESC NULLS LAST) AS rn FROM fact)
        WHERE rn = 1""",
    ),
    "regtot": (
        ("reg",),
        """SELECT district_key, min(district_name) AS district_name,
            CAST(sum(kapasitas_pagu_siswa) AS BIGINT) AS seats, CAST(sum(jumlah_ruang_kelas) AS BIGINT) AS rooms,
            CAST(sum(jumlah_rombel) AS BIGINT) AS class_groups, count(*) AS schools,
            CAST(max(tahun) AS INTEGER) AS registry_year
        FROM reg WHERE tahun = (SELECT max(tahun) FROM reg) GROUP BY district_key""",
    ),
    "cap": (
        ("regtot", "latest"),
        """SELECT r.*, coalesce(p.pupils, 0) AS pupils, greatest(seats, coalesce(p.pupils, 0)) AS capacity,
            CASE WHEN seats >= coalesce(p.pupils, 0) THEN 'seats' ELSE 'pupils' END AS capacity_source
        FROM regtot r LEFT JOIN (SELECT district_key,
            coalesce(sd_murid, 0) + coalesce(smp_murid, 0) + coalesce(mi_murid, 0) + coalesce(mts_murid, 0) AS pupils
            FROM latest) p USING (district_key)""",
    ),
    "seatcap": (("regtot",), "SELECT *, seats AS capacity, CAST(0 AS BIGINT) AS pupils FROM regtot"),
}


def _gap_sql(capacity_cte: str) -> str:
    return f"""SELECT p.*, coalesce(c.capacity, 0) AS capacity, c.seats, c.pupils, c.rooms, c.schools,
            c.district_key IS NOT NULL AS capacity_known,
            p.demand_total - coalesce(c.capacity, 0) AS gap,
            greatest(p.demand_total - coalesce(c.capacity, 0), 0) AS unserved,
            CASE WHEN coalesce(c.capacity, 0) > 0
                 THEN {sql_round('p.demand_total / c.capacity * 100', 1)} END AS utilization_pct
        FROM proj p LEFT JOIN {capacity_cte} c ON p.district_key = c.district_key"""


CTES |= {
    "gap": (("proj", "cap"), _gap_sql("cap")),
    "gaps": (("proj", "seatcap"), _gap_sql("seatcap")),
    "rec": (
        ("gaps",),
        f"""SELECT *, CAST(ceil(unserved / 32) AS INTEGER) AS rooms_needed,
            CASE WHEN unserved <= 0 THEN 'CUKUP'
                 WHEN unserved >= CASE WHEN schools > 0 THEN capacity / schools ELSE 0e0 END THEN 'USB'
                 ELSE 'RKB' END AS recommendation,
            unserved AS priority_score,
            CAST(row_number() OVER (ORDER BY unserved DESC, district_key) AS INTEGER) AS priority_rank
        FROM gaps WHERE year = {TARGET_YEAR}""",
    ),
    "idxin": (
        ("gaps",),
        f"""SELECT district_key, min(district_name) AS district_name,
            CAST(max(demand_total) FILTER (year = {BASE_YEAR}) AS DOUBLE) AS demand_base,
            CAST(max(demand_total) FILTER (year = {TARGET_YEAR}) AS DOUBLE) AS demand_target,
            CAST(max(capacity) AS DOUBLE) AS capacity, max(schools) AS schools,
            coalesce(max(utilization_pct) FILTER (year = {TARGET_YEAR}), 0e0) AS utilization_target,
            CAST(coalesce(max(unserved) FILTER (year = {TARGET_YEAR}), 0) AS DOUBLE) AS deficit_target
        FROM gaps WHERE capacity_known AND year IN ({BASE_YEAR}, {TARGET_YEAR}) GROUP BY district_key""",
    ),
    "idx": (
        ("idxin",),
        f"""SELECT *, CASE WHEN index_score >= 70 THEN 'KRITIS' WHEN index_score >= 50 THEN 'TINGGI'
                WHEN index_score >= 30 THEN 'SEDANG' WHEN index_score > 0 THEN 'RENDAH' ELSE 'AMAN' END AS index_category,
            CAST(row_number() OVER (ORDER BY index_score DESC, district_key) AS INTEGER) AS index_rank
        FROM (SELECT *, {sql_round('least(100e0, index_raw * 100e0)', 2)} AS index_score
            FROM (SELECT *, 0.5e0 * deficit_rate + 0.3e0 * utilization_norm + 0.2e0 * growth_rate AS index_raw
                FROM (SELECT *,
                    CASE WHEN demand_target > 0 THEN greatest(0e0, (demand_target - capacity) / demand_target) ELSE 0e0 END
                        AS deficit_rate,
                    least(1e0, utilization_target / 200e0) AS utilization_norm,
                    CASE WHEN demand_base > 0
                         THEN least(1e0, greatest(0e0, (demand_target - demand_base) / demand_base)) ELSE 0e0 END
                        AS growth_rate
                    FROM idxin)))""",
    ),
    "ape": (
        ("proj", "latest"),
        f"""SELECT p.district_key, CAST(p.demand_total AS DOUBLE) AS projected, a.actual,
            abs(CAST(p.demand_total AS DOUBLE) - a.actual) / a.actual * 100 AS ape
        FROM proj p JOIN (SELECT district_key, CAST(coalesce(sd_murid, 0) + coalesce(smp_murid, 0) AS DOUBLE) AS actual
            FROM latest) a USING (district_key)
        WHERE p.year = {BASE_YEAR} AND a.actual > 0""",
    ),
    "regions": (
        (),
        "SELECT n_name AS district_key, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    ),
}

LOCATED_SQL = (
    "-7.2e0 - (CAST(split_part(district_key, '_', 2) AS INTEGER) % 5) * 0.03e0"
    " - CAST(split_part(district_key, '_', 2) AS INTEGER) * 0.001e0 AS latitude, "
    "112.6e0 + (CAST(split_part(district_key, '_', 2) AS INTEGER) * 7 % 25) * 0.01e0 AS longitude"
)


def sql(body: str, *needs: str, **extra: str) -> str:
    """``body`` under the CTEs it needs; ``extra`` adds local ones after them."""
    chosen: dict[str, str] = {}

    def add(name: str) -> None:
        if name in chosen:
            return
        deps, text = CTES[name]
        for d in deps:
            add(d)
        chosen[name] = text

    for n in needs:
        add(n)
    chosen |= extra
    return ("WITH " + ",\n".join(f"{n} AS ({t})" for n, t in chosen.items()) + "\n" if chosen else "") + body
