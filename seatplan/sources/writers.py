"""Tables, CSV exports, multi-dataset ingest and the layer inventory."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def overwrite_table(df: DataFrame, root: str, table: str, *, partition_by: Sequence[str] = ()) -> str:
    """Replace a table, schema included. Small marts come out as one file through AQE's coalescing."""
    path = f"{root.rstrip('/')}/{table}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def export_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> str:
    """Distributed CSV export of chosen columns."""
    (df.select(*columns) if columns else df).write.mode("overwrite").csv(path, header=True)
    return path


@dataclass(frozen=True)
class Outcome:
    table: str
    rows: int | None = None
    error: str | None = None

    @property
    def skipped(self) -> bool:
        return self.rows == 0


def write_counted(df: DataFrame, root: str, table: str, *, source: DataFrame | None = None, **options) -> Outcome:
    """Write and learn the row count from the same job.

    With a ``source`` that turns out empty nothing is written and the old table
    stays. Give the scan the rows come from: asking a derived frame whether it
    is empty would compute it once more.
    """
    if source is not None and source.isEmpty():
        return Outcome(table, 0)
    seen = Observation()
    overwrite_table(df.observe(seen, F.count("*").alias("rows")), root, table, **options)
    return Outcome(table, seen.get["rows"])


def each_isolated(jobs: Mapping[str, Callable[[], Outcome]]) -> list[Outcome]:
    """Run every job; one that fails is reported and does not stop the others."""
    out = []
    for table, job in jobs.items():
        try:
            out.append(job())
        except (PySparkException, Py4JJavaError) as e:
            condition = e.getCondition() if isinstance(e, PySparkException) else None
            out.append(Outcome(table, error=condition or str(e).strip().splitlines()[0]))
    return out


def layer_inventory(layers: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """(layer, table, rows, files) for named tables; Parquet answers counts from footers."""
    parts = [
        df.select(F.col("_metadata.file_path").alias("_f"))
        .groupBy("_f").agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"), F.count("*").alias("files"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows", "files")
        for layer, table, df in layers
    ]
    return reduce(DataFrame.unionByName, parts)


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_json_arrays(df: DataFrame, path: str, number: str, records_per_array: int) -> str:
    """Records as JSON arrays, one array per line; ``number`` counts the records and bounds each array."""
    arrays = (
        df.withColumn("_g", F.floor(F.col(number) / records_per_array))
        .groupBy("_g").agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("value"))
    )
    arrays.select("value").write.mode("errorifexists").text(path)
    return path
