"""String cleaning expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Administrative prefixes; the dot belongs to the prefix.
NAME_PREFIXES = ("kec.", "kel.")


def normalize_name(name: Column, prefixes: tuple[str, ...] = NAME_PREFIXES) -> Column:
    """Display name: one leading prefix dropped, whitespace runs collapsed, upper case."""
    any_prefix = "|".join(re.escape(p) for p in prefixes)
    bare = F.regexp_replace(name, rf"(?i)^\s*(?:{any_prefix})", "")
    return F.upper(F.trim(F.regexp_replace(bare, r"\s+", " ")))


def join_key(name: Column) -> Column:
    """The display name without any whitespace, so spelling variants meet in joins."""
    return F.regexp_replace(name, r"\s+", "")


def normalize_period(period: Column) -> Column:
    return F.initcap(F.lower(F.trim(period)))


def is_blank(value: Column) -> Column:
    """NULL, or only spaces once written as text."""
    return value.isNull() | (F.trim(value.cast("string")) == "")


def contains_text(value: Column, needle: str) -> Column:
    return F.contains(F.lower(value), F.lit(needle.lower()))


def count_with_share(count: Column, share: Column) -> Column:
    """``n (p%)`` as the quality report prints it."""
    return F.format_string("%d (%s%%)", count.cast("long"), share.cast("string"))


def slashed(*counts: Column) -> Column:
    """``a/b/c``."""
    return F.concat_ws("/", *[c.cast("string") for c in counts])
