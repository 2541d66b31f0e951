"""Latest state of periodic facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatplan.functions.calendar import month_rank


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: Sequence[Column]) -> DataFrame:
    """Per key the row with the greatest recency; NULL recency loses.

    ``max`` over a struct aggregates partially, so no key's history is gathered
    in one task as a window would do. Equal recency is settled by the payload.
    """
    rest = [c for c in df.columns if c not in keys]
    settling = [c for c in rest if comparable(df.schema[c].dataType)]
    rank = F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(recency)], F.struct(*settling).alias("_row"))
    if len(settling) == len(rest):
        newest = F.max(rank)["_row"]
    else:
        newest = F.max_by(F.struct(*rest), rank)
    return df.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*").select(*df.columns)


def comparable(kind: T.DataType) -> bool:
    """Whether values of a type have an order; maps have none."""
    if isinstance(kind, T.MapType | T.VariantType):
        return False
    if isinstance(kind, T.ArrayType):
        return comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(comparable(f.dataType) for f in kind.fields)
    return True


def latest_snapshot(df: DataFrame, key: str, year: str, month: str) -> DataFrame:
    """Per key the row of the last (year, month), months ranked by name."""
    return latest_per_key(df, [key], [F.col(year), month_rank(F.col(month))])


def latest_marts(tables: Mapping[str, DataFrame], key: str, year: str, month: str) -> dict[str, DataFrame]:
    return {name: latest_snapshot(df, key, year, month) for name, df in tables.items()}


def fold_by_key(
    df: DataFrame, key: str, name: str | None, sums: Mapping[str, Column], maxima: Mapping[str, Column] | None = None
) -> DataFrame:
    """Aggregates per key with one display name, the least spelling.

    Grouping by key and name would split a district with two spellings. A
    minimum over text keeps an aggregation from hashing and makes it sort all
    rows, so rows are first hashed by key and name, and only the few results
    are folded by key.
    """
    maxima = maxima or {}
    first = [c.alias(n) for n, c in {**sums, **maxima}.items()]
    if name is None:
        return df.groupBy(key).agg(*first)
    again = [F.expr(f"sum(`{n}`) AS `{n}`") for n in sums] + [F.expr(f"max(`{n}`) AS `{n}`") for n in maxima]
    return df.groupBy(key, name).agg(*first).groupBy(key).agg(F.min(name).alias(name), *again)


def latest_year_only(df: DataFrame, year: str) -> DataFrame:
    """Rows of the last year, through a scalar subquery instead of a driver round trip."""
    newest = df.agg(F.max(year)).scalar()
    return df.where(F.col(year) == newest)
