"""What the map shows for a choice of facets: tiles, ward shading, months and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise import schemas as V
from lotwise.functions import bins, geojson
from lotwise.functions.months import months_between, year_month
from lotwise.operators.ranks import with_one_row

ZOOM_CELL_PIXELS = 60


def binned(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """Add the bin of a value among all rows, or among those of its group.

    The rows are read by every step of the rank selection: Spark keeps them once they are computed,
    in memory or on the executors' disks, and computes what a lost executor held again.
    """
    df = df.persist()
    cuts = bins.cut_points(df, value, by).withColumnRenamed("cuts", "_cuts")
    return with_one_row(df, cuts, by).withColumn("bin", bins.bin_index(value, "_cuts")).drop("_cuts")


def stat_tiles(shown: DataFrame) -> DataFrame:
    return shown.agg(
        F.coalesce(F.sum("net_units_created"), F.lit(0)).alias("net_units"),
        F.count(F.lit(1)).alias("permits"),
        F.count_if(F.col("status") == V.ACTIVE).alias("active_permits"),
        F.count_if(F.col("status") == V.CLEARED).alias("cleared_permits"),
    )


def ward_totals(shown: DataFrame, wards: DataFrame) -> DataFrame:
    """Net units of every listed ward, zero where nothing is shown.

    Permits without a ward, or in one that is not listed, are not counted.
    """
    totals = (
        shown.filter(F.col("ward") != "")
        .groupBy(F.col("ward").alias("ward_name"))
        .agg(F.sum("net_units_created").alias("net_units"))
    )
    listed = wards.select("ward_name").distinct()
    return listed.join(totals, "ward_name", "left").withColumn(
        "net_units", F.coalesce("net_units", F.lit(0))
    )


def ward_bins(totals: DataFrame) -> DataFrame:
    return binned(totals, "net_units")


def bin_legend(totals: DataFrame, value: str = "net_units") -> DataFrame:
    """Whole-number edges of each bin; the last bin is open and ends at the largest value."""
    totals = totals.persist()
    top = totals.agg(F.greatest(F.lit(1), F.max(value)).alias("top")).scalar()
    return bins.bin_edges(bins.cut_points(totals, value).withColumn("top", top))


def month_axis(per_month: DataFrame) -> DataFrame:
    """Every month from the first to the last one that occurs."""
    span = per_month.agg(F.min("year_month").alias("first"), F.max("year_month").alias("last"))
    day = lambda month: F.to_date(F.concat(month, F.lit("-01")))
    months = months_between(day(F.col("first")), day(F.col("last")))
    return span.select(F.posexplode(months).alias("month_index", "year_month"))


def month_histogram(mapped: DataFrame) -> DataFrame:
    """Applications per month over all mapped permits, whatever the facets say."""
    # Never null: joining by it then adds no filter, and both readers share one shuffle.
    month = F.coalesce(year_month("application_date"), F.lit(""))
    per_month = (
        mapped.filter(F.col("application_date").isNotNull()).groupBy(month.alias("year_month"))
        .agg(F.count(F.lit(1)).alias("permits"))
    )
    return filled_months(per_month)


def filled_months(per_month: DataFrame) -> DataFrame:
    """``permits`` by ``year_month`` for every month of the axis, zero where there are none."""
    return month_axis(per_month).join(per_month, "year_month", "left").select(
        "month_index", "year_month", F.coalesce("permits", F.lit(0)).alias("permits")
    )


def bar_shares(histogram: DataFrame) -> DataFrame:
    """Each month's count as a share of the highest one."""
    top = histogram.agg(F.greatest(F.lit(1), F.max("permits")).alias("top")).scalar()
    return histogram.withColumn("share", F.col("permits") / top)


def zoom_cells(shown: DataFrame, zoom: int) -> DataFrame:
    """Permits per screen cell at a zoom level: a grid in place of marker clustering."""
    points = shown.select(geojson.longitude("geom").alias("lon"), geojson.latitude("geom").alias("lat"))
    x, y = geojson.grid_cell("lon", "lat", zoom, ZOOM_CELL_PIXELS)
    return points.groupBy(x.alias("cell_x"), y.alias("cell_y")).agg(F.count(F.lit(1)).alias("permits"))


def cluster_bins(cells: DataFrame) -> DataFrame:
    """Cells of two or more permits with the bin of their size among all such cells."""
    return binned(cells.filter("permits > 1"), "permits")
