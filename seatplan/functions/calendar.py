"""Month names and their order."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in calendar order.
MONTHS = (
    "Januari", "Februari", "Maret", "April", "Mei", "Juni",
    "Juli", "Agustus", "September", "Oktober", "November", "Desember",
)


def month_rank(name: Column, months: tuple[str, ...] = MONTHS) -> Column:
    """1 for the first month; NULL for a name that is not a month."""
    pairs = chain.from_iterable((F.lit(m), F.lit(i)) for i, m in enumerate(months, start=1))
    return F.create_map(*pairs)[name]


def month_name(number: Column, months: tuple[str, ...] = MONTHS) -> Column:
    return F.get(F.array(*[F.lit(m) for m in months]), number - 1)
