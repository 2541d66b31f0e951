"""Cleaning and de-duplication of landed records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatplan.functions.text import is_blank, join_key, normalize_name, normalize_period
from seatplan.operators.snapshots import comparable

LINEAGE_COLUMNS = ("_ingested_at", "_source", "_hdfs_source", "source_resource_id", "ingested_at")


def trim_strings(df: DataFrame, exclude: Iterable[str] = LINEAGE_COLUMNS) -> DataFrame:
    """Trim every string column in one projection."""
    skip = set(exclude)

    def cleaned(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if field.name in skip or not isinstance(field.dataType, T.StringType):
            return c
        return F.trim(c).alias(field.name)

    return df.select(*[cleaned(f) for f in df.schema.fields])


def add_keys(
    df: DataFrame,
    name_col: str,
    period_col: str | None = None,
    *,
    norm_as: str = "kecamatan_norm",
    key_as: str = "kecamatan_key",
    period_as: str = "periode_norm",
) -> DataFrame:
    """Add the display name, the join key and, when there is one, the clean period."""
    named = df.withColumn(norm_as, normalize_name(F.col(name_col)))
    added = {key_as: join_key(F.col(norm_as))}
    if period_col is not None:
        added[period_as] = normalize_period(F.col(period_col))
    return named.withColumns(added)


def one_per_grain(df: DataFrame, grain: Sequence[str], order: Sequence[str] = (), *, keep: str = "first") -> DataFrame:
    """One row per grain: the least (``first``) or greatest (``last``) by ``order``.

    Remaining ties fall to the other columns, so the kept row does not depend on
    how the input is partitioned. It is an aggregate, not a window: copies
    collapse before the shuffle and a grain held by a third of all rows still
    sends one row per input partition.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    others = [c for c in df.columns if c not in grain and c not in order]
    settling = [c for c in others if comparable(types[c])]
    ranked = F.struct(*[F.col(f"`{c}`") for c in [*order, *settling]])
    payload = F.struct(*[F.col(f"`{c}`") for c in [*order, *others]])
    if not order and not others:
        return df.groupBy(*grain).agg(F.count("*").alias("_n")).select(*df.columns)
    if len(settling) == len(others):
        pick = F.min(payload) if keep == "first" else F.max(payload)
    else:
        pick = F.min_by(payload, ranked) if keep == "first" else F.max_by(payload, ranked)
    return df.groupBy(*grain).agg(pick.alias("_kept")).select(*grain, "_kept.*").select(*df.columns)


def drop_blank_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(~is_blank(F.col(key)))


def cast_columns(df: DataFrame, types: Mapping[str, str], rejects_as: str | None = None) -> DataFrame:
    """Cast text to real types; unreadable text becomes NULL and can be counted per row."""
    cast = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    if rejects_as is not None:
        failed = [(F.col(c).isNotNull() & v.isNull()).cast("int") for c, v in cast.items()]
        total = failed[0]
        for one in failed[1:]:
            total = total + one
        cast[rejects_as] = total
    return df.withColumns(cast)


def drop_technical(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)
