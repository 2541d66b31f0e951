"""WARC: which stored response a not-modified revisit stands for, and the headers that result.

Records are ``(record_id, url, at, kind, headers)`` with ``kind`` ``response`` or ``revisit``, lower-case header names in
a map, and optionally a payload ``digest``. A revisit belongs to the latest earlier response of its canonical URL (earlier
by time, then by id). It is resolved if the validators allow: equal ETags where both have one (weak ones compare without
``W/``), else equal Last-Modified, else equal digests; otherwise it is a ``mismatch``, and an ``orphan`` without an earlier
response. Resolved revisits take the stored headers, updated by those that a 304 may change (``PERMITTED``).

The as-of join never puts a URL's whole history in one task: records are dealt by URL and slice of time, each slice looks
back within itself, and what it lacks comes from a short list with one row for each earlier slice.

Null URLs and times make a revisit an orphan and a response unused. Repeated revisit rows are resolved alike; of
responses with the same time and id the one with the largest headers text counts. Null headers are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a 304 carries for the stored response (RFC 9110, 15.4.5, and 9111, 3.2). Fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical(url: Column) -> Column:
    """Without scheme, ``www.``, default port, fragment, tracking parameters and a closing slash; host lower-cased, parameters sorted."""
    rest = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^([^/?]*)", 1)), ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&")
    kept = F.array_join(F.sort_array(F.filter(query, lambda q: (q != "") & ~q.startswith("utm_"))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _text(headers: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")


def merged(stored: Column, update: Column) -> Column:
    allowed = F.map_filter(update, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def resolve(records: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """``(record_id, canonical_url, source_id, status, headers)`` of every revisit; ``headers`` is null unless resolved."""
    empty = F.create_map().cast("map<string,string>")
    digest = F.col("digest") if "digest" in records.columns else F.lit(None).cast("string")
    given = records.select(
        "record_id", canonical(F.col("url")).alias("canonical_url"), F.col("at").cast("timestamp").cast("double").alias("_at"), "kind",
        F.coalesce("headers", empty).alias("_h"), digest.alias("_digest"),
    ).withColumn("_slice", F.floor(F.col("_at") / slice_seconds))
    usable = F.col("canonical_url").isNotNull() & F.col("_at").isNotNull()
    full = given.filter((F.col("kind") == "response") & usable).groupBy("canonical_url", "_slice", "_at", "record_id").agg(
        F.max(F.struct(_text(F.col("_h")).alias("t"), F.map_entries("_h").alias("h"), F.col("_digest").alias("d"))).alias("_r")
    ).select("canonical_url", "_slice", "_at", "record_id", F.lit("response").alias("kind"), F.struct(F.col("_at").alias("at"), F.col("record_id").alias("id"), F.col("_r.h").alias("h"), F.col("_r.d").alias("d")).alias("_source"))
    asks = given.filter("kind = 'revisit'")
    columns = ["canonical_url", "_slice", "_at", "record_id", "kind", "_source", "_h", "_digest"]
    both = asks.filter(usable).withColumn("_source", F.lit(None).cast(full.schema["_source"].dataType)).select(columns).unionByName(
        full.select(*columns[:-2], F.lit(None).cast("map<string,string>").alias("_h"), F.lit(None).cast("string").alias("_digest"))
    )
    # with the same time a response of a smaller id is earlier
    inside = Window.partitionBy("canonical_url", "_slice").orderBy("_at", "record_id", "kind").rowsBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("_near", F.last("_source", ignorenulls=True).over(inside)).filter("kind = 'revisit'")
    over = Window.partitionBy("canonical_url").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = both.groupBy("canonical_url", "_slice").agg(F.max("_source").alias("_last")).withColumn("_far", F.last("_last", ignorenulls=True).over(over))
    found = near.join(slices.select("canonical_url", "_slice", "_far"), ["canonical_url", "_slice"]).withColumn("_source", F.coalesce("_near", "_far"))
    lost = asks.filter(~usable).withColumn("_source", F.lit(None).cast(full.schema["_source"].dataType))
    asked = found.select(columns).unionByName(lost.select(columns))
    stored = F.map_from_entries("_source.h")
    old, new = _etag(stored), _etag(F.col("_h"))
    dated, again = F.element_at(stored, "last-modified"), F.element_at("_h", "last-modified")
    valid = (
        F.when(old.isNotNull() & new.isNotNull(), old == new)
        .when(dated.isNotNull() & again.isNotNull(), dated == again)
        .otherwise(F.coalesce(F.col("_source.d") == F.col("_digest"), F.lit(False)))
    )
    status = F.when(F.col("_source").isNull(), "orphan").when(valid, "resolved").otherwise("mismatch")
    return asked.select(
        "record_id", "canonical_url", F.col("_source.id").alias("source_id"), status.alias("status"),
        F.when(status == "resolved", merged(stored, F.col("_h"))).alias("headers"),
    )


headers_text = _text
