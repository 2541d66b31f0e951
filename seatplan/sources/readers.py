"""Landing files, page envelopes, CSV and boundary files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESOURCE_COLUMN = "source_resource_id"


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, one_document_per_file: bool = True
) -> DataFrame:
    """JSON arrays of records, one row per record.

    A file that is one pretty-printed document is read by one task. Arrays
    written one per line (``one_document_per_file=False``) split like any text.
    Give a schema: inferring one reads the data twice.
    """
    reader = spark.read.option("multiLine", one_document_per_file)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def with_lineage(df: DataFrame, source: str, location: str | Column | None = None, run_at: Column | None = None) -> DataFrame:
    """When, from what and from which file each record came; the file by default per row."""
    place = F.col("_metadata.file_path") if location is None else (F.lit(location) if isinstance(location, str) else location)
    return df.select(
        "*",
        (run_at if run_at is not None else F.current_timestamp()).alias("_ingested_at"),
        F.lit(source).alias("_source"),
        place.alias("_hdfs_source"),
    )


def flatten_pages(pages: DataFrame, resource: str | Column, run_at: Column | None = None) -> DataFrame:
    """Records out of ``{success, result: {records, total}}`` pages.

    Failed pages give nothing, the store's row id is dropped, and each record is
    stamped with its resource and the time.
    """
    stamp = F.date_format(run_at if run_at is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    keep = F.lit(resource) if isinstance(resource, str) else resource
    return (
        pages.where(F.col("success"))
        .select(keep.alias(RESOURCE_COLUMN), F.explode("result.records").alias("_r"))
        .select("_r.*", RESOURCE_COLUMN, stamp.alias("ingested_at"))
        .drop("_id")
    )


def pages_complete(pages: DataFrame, by: str) -> DataFrame:
    """Records fetched against the total the pages announce, per resource."""
    return (
        pages.where(F.col("success"))
        .groupBy(by)
        .agg(F.sum(F.size("result.records")).alias("fetched"), F.max("result.total").alias("total"))
        .withColumn("complete", F.col("fetched") >= F.col("total"))
    )


@dataclass(frozen=True)
class Resource:
    resource_id: str
    topic: str
    key: str
    table: str


def route_union(frames: Mapping[Resource, DataFrame]) -> DataFrame:
    """All resources in one frame, each row with its topic and message key; missing columns become NULL."""
    routed = [
        df.withColumns({RESOURCE_COLUMN: F.lit(r.resource_id), "topic": F.lit(r.topic), "key": F.lit(r.key)})
        for r, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), routed)


GEOJSON_SCHEMA = (
    "type string, features array<struct<type: string,"
    "properties: struct<kecamatan_norm: string, latitude: double, longitude: double>,"
    "geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
)


SHAPE_SCHEMA = (
    "type string, properties struct<kecamatan_norm: string, latitude: double, longitude: double>,"
    "geometry struct<type: string, coordinates: string>"
)
_RING = "array<array<double>>"


def read_boundaries(spark: SparkSession, path: str, *, one_document_per_file: bool = True, properties: str | None = None) -> DataFrame:
    """One row per feature: properties and all ``rings``, holes and the parts of MultiPolygons alike.

    A file is one feature collection, or (``one_document_per_file=False``) holds a feature per line and splits like any text.
    ``properties`` names others to read, as DDL. Features without an area have no rings.
    """
    schema = SHAPE_SCHEMA if properties is None else f"type string, properties struct<{properties}>, geometry struct<type: string, coordinates: string>"
    if one_document_per_file:
        fields = spark.createDataFrame([], schema).schema
        whole = T.StructType([T.StructField("features", T.ArrayType(fields))])
        features = spark.read.schema(whole).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")
    else:
        features = spark.read.schema(schema).json(path)
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    rings = F.when(kind == "Polygon", F.from_json(text, f"array<{_RING}>")).when(
        kind == "MultiPolygon", F.flatten(F.from_json(text, f"array<array<{_RING}>>"))
    )
    return features.select("properties.*", F.coalesce(rings, F.array().cast(f"array<{_RING}>")).alias("rings"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per polygon feature: properties and the outer ring of ``[lon, lat]`` pairs."""
    return (
        spark.read.schema(GEOJSON_SCHEMA).option("multiLine", True).json(path)
        .select(F.explode("features").alias("f"))
        .select("f.properties.*", F.col("f.geometry.coordinates")[0].alias("ring"))
    )
