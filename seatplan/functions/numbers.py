"""Arithmetic that is safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def add_or_zero(*values: Column) -> Column:
    """Sum in which a NULL counts as nothing."""
    return reduce(lambda a, b: a + b, [or_zero(v) for v in values])


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; NULL when the whole is zero, negative or NULL."""
    return F.when(whole > 0, part / whole)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def step_label(value: Column, steps: Sequence[tuple[float, str]], below: str, *, strict: Sequence[float] = ()) -> Column:
    """First label whose bound the value reaches; bounds in ``strict`` must be exceeded."""
    label = None
    for bound, text in steps:
        hit = value > bound if bound in strict else value >= bound
        label = F.when(hit, text) if label is None else label.when(hit, text)
    return label.otherwise(below)


def under_label(value: Column, steps: Sequence[tuple[float, str]], above: str) -> Column:
    """First label whose bound lies strictly above the value."""
    label = None
    for bound, text in steps:
        label = F.when(value < bound, text) if label is None else label.when(value < bound, text)
    return label.otherwise(above)


def units_needed(amount: Column, unit: int) -> Column:
    """Whole units that cover an amount."""
    return F.ceil(amount / F.lit(unit)).cast("int")


def whole_number(value: Column) -> Column:
    """Nearest whole number, halves upward, as the dashboard rounds."""
    return F.floor(value + F.lit(0.5)).cast("long")
