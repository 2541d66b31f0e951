"""Keeping old versions of a Parquet table readable.

A version is a folder of Parquet files plus one manifest row naming it. The row
is written last, so readers never see a half-written version; a failed write
leaves only an unnamed folder. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "version int, folder string, written_at timestamp, operation string, rows long"


class UnknownVersion(LookupError):
    pass


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def current_version(spark: SparkSession, path: str) -> int | None:
    return _manifest(spark, path).agg(F.max("version")).first()[0]


def write_version(df: DataFrame, path: str, operation: str = "WRITE", *, written_at: Column | None = None) -> int:
    """Store ``df`` as the next version and return its number; the schema may differ from before."""
    spark = df.sparkSession
    last = current_version(spark, path)
    number = 0 if last is None else last + 1
    folder = f"data/{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.mode("errorifexists").parquet(f"{path}/{folder}")
    entry = spark.range(1).select(
        F.lit(number).alias("version"), F.lit(folder).alias("folder"),
        (written_at if written_at is not None else F.current_timestamp()).alias("written_at"),
        F.lit(operation).alias("operation"), F.lit(seen.get["rows"]).cast("long").alias("rows"),
    )
    entry.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest/v{number}")
    return number


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version (default: the current one), with that version's schema."""
    wanted = current_version(spark, path) if version is None else version
    found = _manifest(spark, path).where(F.col("version") == F.lit(wanted)).select("folder").first()
    if found is None:
        raise UnknownVersion(f"{path} has no version {wanted}")
    return spark.read.parquet(f"{path}/{found[0]}")


def history(spark: SparkSession, path: str, most: int = 5) -> DataFrame:
    return _manifest(spark, path).select("version", "written_at", "operation", "rows").orderBy(F.desc("version")).limit(most)


def diff(old: DataFrame, new: DataFrame, key: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed in the compared columns; NULL equals NULL."""
    a = old.select(*key, F.struct(*compare).alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select(*key, F.struct(*compare).alias("_new"), F.lit(True).alias("_in_new"))
    change = (
        F.when(F.col("_in_old").isNull(), "added")
        .when(F.col("_in_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    return a.join(b, list(key), "full_outer").select(*key, change.alias("change")).where(F.col("change").isNotNull())
