"""Counts that show whether the inputs and joins can be trusted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions import clean
from lotwise.functions.clean import has_text

def _finding(df: DataFrame, finding: str, detail: Column) -> DataFrame:
    return (
        df.groupBy(detail.cast("string").alias("detail")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(finding).alias("finding"), "detail", "n")
    )


def permit_keys(staged: DataFrame) -> DataFrame:
    """(permit, source) pairs with more than one staged row, of which there should be none,
    and permits that occur in both sources. One shuffle beyond the staging one."""
    per_source = staged.groupBy("permit_num", "source_status").agg(F.count(F.lit(1)).alias("rows"))
    per_permit = per_source.groupBy("permit_num").agg(
        F.count(F.lit(1)).alias("sources"), F.count_if(F.col("rows") > 1).alias("repeated")
    )
    counts = per_permit.agg(
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated permits"),
        F.count_if(F.col("sources") > 1).alias("permits in both sources"),
    )
    long = counts.unpivot([], counts.columns, "finding", "n")
    return long.select("finding", F.lit("all").alias("detail"), "n")


def unreadable(rows: DataFrame) -> DataFrame:
    """Filled number and date texts that no cast can read, by column."""
    casts = {
        "dwelling_units_created": clean.whole_number, "dwelling_units_lost": clean.whole_number,
        "application_date": clean.day, "issued_date": clean.day, "completed_date": clean.day,
    }
    counts = rows.agg(*[F.count_if(has_text(c) & cast(c).isNull()).alias(c) for c, cast in casts.items()])
    unpivoted = counts.unpivot([], list(casts), "detail", "n")
    return unpivoted.select(F.lit("unreadable").alias("finding"), "detail", "n")


def repeated_addresses(addresses: DataFrame) -> DataFrame:
    """Address ids with more than one row: these repeat the permits they match."""
    return (
        addresses.dropna(subset=["address_point_id"]).groupBy("address_point_id").count()
        .filter("count > 1")
    )


def address_findings(rows: DataFrame) -> DataFrame:
    """Repeated ids, geometries given and geometries read, in one pass over numbered address rows
    (``address_point_id``, ``geom_given``, ``geom_read``): what is shuffled is one row per id."""
    per_id = rows.groupBy("address_point_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("geom_given").alias("given"), F.count_if("geom_read").alias("read")
    )
    repeated = F.col("address_point_id").isNotNull() & (F.col("rows") > 1)
    counts = per_id.agg(
        F.count_if(repeated).alias("repeated address ids"),
        F.coalesce(F.sum("given"), F.lit(0)).alias("given"), F.coalesce(F.sum("read"), F.lit(0)).alias("read"),
    )
    long = counts.unpivot([], counts.columns, "name", "n")
    total = F.col("name") == "repeated address ids"
    return long.select(
        F.when(total, F.col("name")).otherwise("geometry").alias("finding"),
        F.when(total, "all").otherwise(F.col("name")).alias("detail"), "n",
    )


def bad_geometry(raw_addresses: DataFrame, addresses: DataFrame) -> DataFrame:
    """Geometry texts given, and geometries read."""
    given = raw_addresses.agg(F.count("geometry").alias("n")).select(F.lit("given").alias("detail"), "n")
    read = addresses.agg(F.count("geom").alias("n")).select(F.lit("read").alias("detail"), "n")
    return given.unionByName(read).select(F.lit("geometry").alias("finding"), "detail", "n")


def geocode_rate(placed: DataFrame) -> DataFrame:
    return _finding(placed, "geocode", F.col("geocode_method"))


def label_agreement(labelled: DataFrame) -> DataFrame:
    """How often the final label is the rule's, for texts that have both axes."""
    same_form = F.col("unit_form") == F.col("rule_unit_form")
    same_type = F.col("construction_type") == F.col("rule_construction_type")
    verdict = (
        F.when(same_form & same_type, "both").when(same_form, "unit_form only")
        .when(same_type, "construction_type only").otherwise("neither")
    )
    return _finding(labelled, "agrees with rules on", verdict)


def label_pairs(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("rule_construction_type", "construction_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def report(
    raw_permits: DataFrame, staged: DataFrame, address_rows: DataFrame, placed: DataFrame, labelled: DataFrame,
) -> DataFrame:
    """All findings. Every frame is read for one aggregate: raw permits only in the columns that may
    be unreadable, addresses in the narrow columns of their numbered rows."""
    parts = [
        permit_keys(staged), unreadable(raw_permits), address_findings(address_rows), geocode_rate(placed),
        label_agreement(labelled),
    ]
    return reduce(DataFrame.unionByName, parts)
