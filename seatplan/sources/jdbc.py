"""Publishing marts to, and reading them from, a relational store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from seatplan.sources.writers import Outcome, each_isolated


def publish_options(url: str, table: str, *, batch: int = 10_000, connections: int = 8, **login: str) -> dict[str, str]:
    """``truncate`` empties the table instead of dropping it, so its keys and indexes survive."""
    return {
        "url": url, "dbtable": table, "truncate": "true",
        "batchsize": str(batch), "numPartitions": str(connections), **login,
    }


def publish(df: DataFrame, url: str, table: str, **options) -> Outcome:
    df.write.format("jdbc").options(**publish_options(url, table, **options)).mode("overwrite").save()
    return Outcome(table)


def publish_all(tables: Mapping[str, DataFrame], url: str, **options) -> list[Outcome]:
    """Every table by itself: one that fails is reported, the rest are published."""
    return each_isolated({t: (lambda t=t, df=df: publish(df, url, t, **options)) for t, df in tables.items()})


def read(
    spark: SparkSession, url: str, table: str, columns: Sequence[str] = (), where: str | None = None, *,
    split_on: str | None = None, bounds: tuple[int, int] | None = None, connections: int = 8, **login: str,
) -> DataFrame:
    """A table with columns and filter pushed to the store; ``split_on`` reads it in parallel ranges."""
    options = {"url": url, "dbtable": table, **login}
    if split_on is not None:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        options |= {
            "partitionColumn": split_on, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(connections),
        }
    df = spark.read.format("jdbc").options(**options).load()
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df
