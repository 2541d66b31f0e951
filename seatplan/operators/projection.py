"""Age vectors and the cohort-shift projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatplan.functions.numbers import add_or_zero
from seatplan.operators.snapshots import fold_by_key

# How the population table spells the ages 0..16, and the two sexes.
AGE_WORDS = (
    "nol", "satu", "dua", "tiga", "empat", "lima", "enam", "tujuh", "delapan", "sembilan",
    "sepuluh", "sebelas", "duabelas", "tigabelas", "empatbelas", "limabelas", "enambelas",
)
SEX_SUFFIXES = ("laki", "perempuan")

# Ages served by each school level.
BANDS = {"demand_sd": (7, 12), "demand_smp": (13, 15)}
AGES = range(16)


def wide_age(age: int, words: Sequence[str] = AGE_WORDS, suffixes: Sequence[str] = SEX_SUFFIXES) -> Column:
    """People of one age in a wide row, both sexes, NULL as none."""
    return add_or_zero(*[F.col(f"{words[age]}_{s}") for s in suffixes])


def age_vector_from_wide(
    df: DataFrame, key: str, name: str | None = None, *, ages: Iterable[int] = AGES, prefix: str = "usia_", measure=wide_age
) -> DataFrame:
    """One row per district, one column per age."""
    sums = {f"{prefix}{a}": F.sum(measure(a)).cast("long") for a in ages}
    return fold_by_key(df, key, name, sums)


def age_vector_from_long(
    df: DataFrame, key: str, age: str, people: str, name: str | None = None, *, ages: Iterable[int] = AGES, prefix: str = "usia_"
) -> DataFrame:
    """As above from (key, age, people) rows, in a single pass."""
    sums = {
        f"{prefix}{a}": F.expr(f"CAST(coalesce(sum(CASE WHEN `{age}` = {a} THEN `{people}` END), 0) AS BIGINT)") for a in ages
    }
    return fold_by_key(df, key, name, sums)


def unpivot_ages(vector: DataFrame, ids: Sequence[str], *, ages: Iterable[int] = AGES, prefix: str = "usia_") -> DataFrame:
    pairs = ", ".join(f"named_struct('age', {a}, 'people', `{prefix}{a}`)" for a in ages)
    return vector.select(*ids, F.expr(f"inline(array({pairs}))"))


def cohort_projection(
    vector: DataFrame,
    ids: Sequence[str],
    base_year: int,
    horizon: int,
    *,
    bands: Mapping[str, tuple[int, int]] = BANDS,
    ages: Iterable[int] = AGES,
    prefix: str = "usia_",
    year_as: str = "year",
    total_as: str = "demand_total",
) -> DataFrame:
    """Demand per district and year if everybody simply grows older.

    In year ``base + k`` a band is filled by those ``k`` years younger today;
    children not yet born add nothing, so any horizon is allowed. Each district
    row unfolds into its years by one ``inline``: no union, no join, no shuffle.
    """
    known = set(ages)

    def filled_by(low: int, high: int, k: int) -> str:
        present = [f"`{prefix}{a}`" for a in range(low - k, high - k + 1) if a in known]
        return " + ".join(present) or "0L"

    years = []
    for k in range(horizon + 1):
        parts = {name: filled_by(low, high, k) for name, (low, high) in bands.items()}
        fields = ", ".join(f"'{n}', {v}" for n, v in parts.items())
        years.append(f"named_struct('{year_as}', {base_year + k}, {fields}, '{total_as}', {' + '.join(parts.values())})")
    return vector.select(*ids, F.expr(f"inline(array({', '.join(years)}))"))
