"""The map view from sums: permits and units by every facet, month and ward, stored once.

Whatever a reader switches on or off, tiles, ward totals and months follow from these rows alone.
There are as many as combinations of values that occur, however many permits there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise import schemas as V
from lotwise.functions import geojson
from lotwise.functions.months import year_month
from lotwise.functions.morton import cell_of, coarser, morton_key
from lotwise.operators.facets import Facets, month_passes, passes_layers
from lotwise.plans import map_view

FACETS = ["status", "road_class", "structure_category", "exterior_visibility"]
MONTH = "application_month"
FINEST_ZOOM = 19
# Cells are counted from this many cells of the finest zoom left of and above the map, so that
# points beyond its edge have places above 0 as well.
MARGIN = 1 << 27


def facet_cube(mapped: DataFrame) -> DataFrame:
    """``permits`` and ``net_units`` by facets, month of application and ward."""
    return mapped.groupBy(*FACETS, year_month("application_date").alias(MONTH), "ward").agg(
        F.count(F.lit(1)).alias("permits"), F.sum("net_units_created").alias("net_units")
    )


def chosen(cube: DataFrame, facets: Facets = Facets()) -> DataFrame:
    """The rows that a choice of facets shows."""
    return cube.filter(passes_layers(facets) & month_passes(F.col(MONTH), facets))


def stat_tiles(rows: DataFrame) -> DataFrame:
    def permits(status: str):
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("permits"))), F.lit(0))

    return rows.agg(
        F.coalesce(F.sum("net_units"), F.lit(0)).alias("net_units"),
        F.coalesce(F.sum("permits"), F.lit(0)).alias("permits"),
        permits(V.ACTIVE).alias("active_permits"), permits(V.CLEARED).alias("cleared_permits"),
    )


def ward_totals(rows: DataFrame, wards: DataFrame) -> DataFrame:
    return map_view.ward_totals(rows.withColumnRenamed("net_units", "net_units_created"), wards)


def facet_counts(rows: DataFrame) -> DataFrame:
    """Permits and units by facet and value, for the switches themselves; one pass over the rows."""
    kinds = F.array(*[F.struct(F.lit(name).alias("facet"), F.col(name).alias("value")) for name in FACETS])
    return (
        rows.select(F.explode(kinds).alias("k"), "permits", "net_units").groupBy("k.facet", "k.value")
        .agg(F.sum("permits").alias("permits"), F.coalesce(F.sum("net_units"), F.lit(0)).alias("net_units"))
    )


def month_histogram(cube: DataFrame) -> DataFrame:
    """Applications per month over the whole cube, whatever the facets say."""
    known = F.coalesce(MONTH, F.lit(""))
    per_month = (
        cube.filter(F.col(MONTH).isNotNull()).groupBy(known.alias("year_month"))
        .agg(F.sum("permits").alias("permits"))
    )
    return map_view.filled_months(per_month)


def cell_pyramid(shown: DataFrame, coarsest: int = 0, finest: int = FINEST_ZOOM) -> DataFrame:
    """Permits per screen cell at every zoom level: ``zoom``, ``cell_x``, ``cell_y``, ``permits``.

    Permits are read once, for the cells of the finest zoom. A cell of a zoom level is four cells of
    the next, so all other levels are sums of the finest cells, by their numbers without the last
    bits. Permits without a place are counted in a cell without one.
    """
    points = shown.select(geojson.longitude("geom").alias("lon"), geojson.latitude("geom").alias("lat"))
    x, y = geojson.grid_cell("lon", "lat", finest, map_view.ZOOM_CELL_PIXELS)
    cells = points.groupBy(morton_key(x + MARGIN, y + MARGIN).alias("key")).agg(F.count(F.lit(1)).alias("permits"))
    zooms = F.sequence(F.lit(coarsest), F.lit(finest))
    levels = F.lit(finest) - F.col("zoom")
    every = (
        cells.select("key", "permits", F.explode(zooms).alias("zoom"))
        .select("zoom", coarser(F.col("key"), levels).alias("key"), "permits")
        .groupBy("zoom", "key").agg(F.sum("permits").alias("permits"))
    )
    margin = F.call_function("shiftright", F.lit(MARGIN), levels)
    cell_x, cell_y = cell_of(F.col("key"))
    return every.select("zoom", (cell_x - margin).alias("cell_x"), (cell_y - margin).alias("cell_y"), "permits")


def pyramid_bins(pyramid: DataFrame) -> DataFrame:
    """Cells of two or more permits with the bin of their size among such cells of their zoom."""
    return map_view.binned(pyramid.filter("permits > 1"), "permits", ["zoom"])
