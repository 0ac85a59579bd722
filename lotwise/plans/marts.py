"""Small result tables over the multiplex rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.months import year_month


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("permit_count"),
        F.sum("net_units_created").alias("net_units_created"),
    ]


def by_ward(housing: DataFrame) -> DataFrame:
    """Permits and units by ward and status; permits without a ward form their own group."""
    return housing.groupBy("ward", "status").agg(*_counts()).orderBy(F.asc_nulls_last("ward"), "status")


def by_month(housing: DataFrame) -> DataFrame:
    """By month of the latest known step of the permit: completed, issued or applied for."""
    month = year_month(F.coalesce("completed_date", "issued_date", "application_date"))
    months = housing.select(month.alias("year_month"), "status", "net_units_created")
    return (
        months.groupBy("year_month", "status").agg(*_counts())
        .orderBy(F.asc_nulls_last("year_month"), "status")
    )


def totals_by_status(housing: DataFrame) -> DataFrame:
    return housing.groupBy("status").agg(*_counts())


def summary(housing: DataFrame, last_updated: str) -> DataFrame:
    """One row: totals by status, permits without a point, first and last application.

    One pass: everything is aggregated per status, then the few status rows are joined up.
    """
    per_status = housing.groupBy("status").agg(
        *_counts(),
        F.count_if(F.col("geom").isNull()).alias("unmatched"),
        F.min("application_date").alias("first"),
        F.max("application_date").alias("last"),
    )
    totals = F.array_sort(F.collect_list(F.struct("status", "permit_count", "net_units_created")))
    return per_status.agg(
        F.lit(last_updated).alias("last_updated"),
        totals.alias("totals_by_status"),
        F.coalesce(F.sum("unmatched"), F.lit(0)).alias("unmatched_address_count"),
        F.min("first").cast("string").alias("earliest_application_date"),
        F.max("last").cast("string").alias("latest_application_date"),
    )
