"""Distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the straight-line fallback: km per degree, minutes per km.
KM_PER_DEGREE = 111
MINUTES_PER_KM = 2
EARTH_RADIUS_KM = 6371.0088


def planar_degrees(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    dlat, dlon = lat_a - lat_b, lon_a - lon_b
    return F.sqrt(dlat * dlat + dlon * dlon)


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def ring_edges(rings: Column) -> Column:
    """The edges ``(ax, ay, bx, by)`` of closed rings of ``[x, y]`` pairs."""
    return F.flatten(F.transform(rings, lambda r: F.zip_with(
        F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))),
        lambda a, b: F.struct(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")),
    )))


def crossings(x: Column, y: Column, edges: Column) -> Column:
    """How many edges a ray from the point to the right crosses."""
    def crossed(e):
        at = F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"]
        return ((e["ay"] > y) != (e["by"] > y)) & (x < at)

    return F.size(F.filter(edges, crossed))


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule over a closed ring of ``[x, y]`` pairs."""
    edges = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1),
                       lambda a, b: F.struct(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")))

    def crossed(e):
        spans = (e["ay"] > y) != (e["by"] > y)
        at = F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"]
        return spans & (x < at)

    return F.size(F.filter(edges, crossed)) % 2 == 1
