"""GeoJSON geometry kept as text: no spatial predicate is needed, only reading and printing."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from lotwise.functions.clean import col

# The geometry types of the GeoJSON format.
GEOMETRY_TYPES = [
    "Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon",
    "GeometryCollection",
]
POINT_SCHEMA = "type string, coordinates array<double>"


def geometry(c: Column | str) -> Column:
    """One-line JSON of a readable geometry, NULL for anything else."""
    parsed = F.try_parse_json(col(c))
    kind = F.try_variant_get(parsed, "$.type", "string")
    return F.when(kind.isin(GEOMETRY_TYPES), F.to_json(parsed))


def longitude(geom: Column | str) -> Column:
    return F.try_element_at(F.from_json(col(geom), POINT_SCHEMA)["coordinates"], F.lit(1))


def latitude(geom: Column | str) -> Column:
    return F.try_element_at(F.from_json(col(geom), POINT_SCHEMA)["coordinates"], F.lit(2))


def feature(geom: Column | str, properties: list[Column | str]) -> Column:
    """One feature as one line of JSON; missing properties are written as null."""
    body = F.struct(
        F.lit("Feature").alias("type"),
        F.try_parse_json(col(geom)).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def grid_cell(lon: Column | str, lat: Column | str, zoom: int, pixels: int) -> tuple[Column, Column]:
    """Square screen cell of a point on the usual web map at a zoom level."""
    world = 256.0 * 2**zoom
    angle = F.radians(col(lat))
    x = (col(lon) + 180.0) / 360.0 * world
    y = (1.0 - F.ln(F.tan(angle) + 1.0 / F.cos(angle)) / math.pi) / 2.0 * world
    return F.floor(x / pixels), F.floor(y / pixels)
