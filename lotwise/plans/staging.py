"""Raw tables to one clean row per permit, address, street and ward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise import schemas as V
from lotwise.functions import clean
from lotwise.functions.categories import road_class
from lotwise.functions.geojson import geometry
from lotwise.operators.first_row import first_per_key, most_common

# Columns by what a consumer needs; each level holds those before it. Ties between rows of
# the same revision are broken by the columns in this order, so a narrow level picks the
# same row as a wide one and can leave the long texts in the file.
SCOPE = [
    "revision_num", "dwelling_units_created", "dwelling_units_lost", "structure_type",
    "proposed_use", "permit_status",
]
PLACE = [
    *SCOPE, "application_date", "issued_date", "completed_date", "geo_id",
    "street_num", "street_name", "street_type", "street_direction",
]
TEXT = [*PLACE, "description"]
ALL = [*TEXT, "permit_type", "work", "current_use", "residential_area"]
PERMIT_KEY = ["permit_num", "source_status"]


def both_sources(cleared: DataFrame, active: DataFrame) -> DataFrame:
    """One frame of raw permits that says which table a row came from."""
    return cleared.withColumn("source_status", F.lit(V.CLEARED)).unionByName(
        active.withColumn("source_status", F.lit(V.ACTIVE))
    )


def _permit_columns() -> dict[str, Column]:
    special = {
        "street_num": clean.street_number("street_num"),
        "street_name": clean.street_text("street_name"),
        "street_type": clean.street_text("street_type"),
        "street_direction": clean.street_direction("street_direction"),
        "geo_id": clean.whole_number("geo_id", "bigint"),
        "permit_status": F.col("status"),
        "residential_area": F.col("residential"),
    }
    return {name: special.get(name, F.col(name)) for name in ALL}


def permit_rows(raw: DataFrame, columns: list[str] = ALL) -> DataFrame:
    """Renamed and cleaned permit rows, still one per revision."""
    made = _permit_columns()
    return raw.select(*PERMIT_KEY, *[made[c].alias(c) for c in columns])


def latest_revisions(rows: DataFrame) -> DataFrame:
    """The highest revision of each permit within its source; unreadable revisions come last.

    Both sources go through one shuffle.
    """
    ties = [F.asc_nulls_last(c) for c in ALL if c in rows.columns and c != "revision_num"]
    order = [clean.whole_number("revision_num").desc_nulls_last(), F.desc_nulls_last("revision_num"), *ties]
    return first_per_key(rows, PERMIT_KEY, order)


def permits(raw: DataFrame, columns: list[str] = ALL) -> DataFrame:
    return latest_revisions(permit_rows(raw, columns))


def addresses(raw: DataFrame, with_given: bool = False) -> DataFrame:
    """``with_given`` adds whether a geometry was given at all, readable or not."""
    given = [F.col("geometry").isNotNull().alias("geom_given")] if with_given else []
    return raw.select(
        clean.whole_number("address_point_id", "bigint").alias("address_point_id"),
        clean.street_number("address_number").alias("street_num"),
        clean.street_text("linear_name").alias("street_name"),
        clean.street_text("linear_name_type").alias("street_type"),
        clean.street_direction("linear_name_dir").alias("street_direction"),
        F.col("address_full").alias("full_address"),
        F.col("ward_name").alias("ward"),
        geometry("geometry").alias("geom"),
        *given,
    )


def streets(raw: DataFrame) -> DataFrame:
    """Most common feature and its road class per street."""
    named = raw.filter(F.col("feature_code_desc").isNotNull()).select(
        clean.street_text("linear_name").alias("street_name"),
        clean.street_text("linear_name_type").alias("street_type"),
        clean.street_direction("linear_name_dir").alias("street_direction"),
        F.col("feature_code_desc").alias("road_feature"),
    )
    keys = ["street_name", "street_type", "street_direction"]
    common = most_common(named, keys, "road_feature")
    return common.select(*keys, "road_feature", road_class("road_feature").alias("road_class"))


def current_wards(raw: DataFrame, as_of: str) -> DataFrame:
    """Wards that expire after the day; a missing or unreadable expiry is dropped."""
    return raw.filter(clean.moment("date_expiry") > F.lit(as_of).cast("date").cast("timestamp")).select(
        F.col("area_short_code").alias("ward_code"),
        F.col("area_name").alias("ward_name"),
        geometry("geometry").alias("geom"),
    )
