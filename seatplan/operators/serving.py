"""Serving queries: what the read interface answers, as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatplan.operators.clusters import cluster_members
from seatplan.operators.ranking import page, top_k

# Bookkeeping columns that are not served; districts of the city, the most its ranked lists are asked for.
TECHNICAL_COLUMNS = (
    "_gold_created_at", "_processed_at", "_updated_at", "_generated_at", "_refreshed_at", "id",
)
MOST_RANKED = 31


class UnknownTable(LookupError):
    pass


class UnknownKey(LookupError):
    pass


class Catalog:
    """Named tables with a description; a table is a frame or a function that builds one when asked for."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, tuple[str, DataFrame | Callable[[], DataFrame]]]):
        self._spark = spark
        self._tables = dict(tables)

    def list_tables(self) -> DataFrame:
        rows = [(n, d) for n, (d, _) in self._tables.items()]
        described = self._spark.createDataFrame(rows, "table_name string, description string")
        counts = reduce(DataFrame.unionByName, [self.count(n) for n, _ in rows])
        return described.join(counts.withColumnRenamed("count", "record_count"), "table_name").withColumn(
            "total_tables", F.lit(len(rows))
        )

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise UnknownTable(name)
        found = self._tables[name][1]
        return (found() if callable(found) else found).drop(*TECHNICAL_COLUMNS)

    def page(self, name: str, order, *, limit: int = 100, offset: int = 0) -> DataFrame:
        """One page; every row carries the table's full row count."""
        rows = self.table(name)
        return page(rows, order, limit=limit, offset=offset).withColumn("record_count", rows.agg(F.count("*")).scalar())

    def count(self, name: str) -> DataFrame:
        return self.table(name).agg(F.count("*").alias("count")).withColumn("table_name", F.lit(name))


def ranked(
    df: DataFrame, rank: str, *, top: int, label: str | None = None, wanted: str | None = None, most: int | None = None
) -> DataFrame:
    """Best ``top`` rows, optionally of one label in any case; ``count`` tells how many there were.

    ``most`` bounds what may be asked for, where the caller's interface has a bound.
    """
    if top < 1 or (most is not None and top > most):
        raise ValueError("top must be positive" if most is None else f"top must lie in 1..{most}")
    only = None if wanted is None else F.col(label) == F.lit(wanted.upper())
    return top_k(df, [F.col(rank).asc_nulls_last()], top, where=only, count_as="count")


def key_argument(text: str) -> str:
    return text.upper().replace(" ", "")


def key_trend(df: DataFrame, key: str, asked: str, year: str) -> DataFrame:
    """A district's rows by year; an unknown district is an error, not an empty answer."""
    rows = df.where(F.col(key) == F.lit(key_argument(asked)))
    if rows.isEmpty():
        raise UnknownKey(asked)
    return rows.orderBy(year)


def cluster_list(clustered: DataFrame, rank: str, priority: str | None = None) -> DataFrame:
    rows = clustered if priority is None else clustered.where(F.col("priority_label") == F.lit(priority.upper()))
    return rows.orderBy(F.col("priority_rank").asc_nulls_last(), F.col(rank).asc_nulls_last())


def cluster_summary(clustered: DataFrame, name: str, priority: str | None = None) -> DataFrame:
    rows = clustered if priority is None else clustered.where(F.col("priority_label") == F.lit(priority.upper()))
    return cluster_members(rows, name)
