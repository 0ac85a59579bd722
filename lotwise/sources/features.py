"""Map files: one GeoJSON feature per line, and the summary object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.functions.geojson import feature

# Property name -> type, in the order in which they are written.
PERMIT_PROPERTIES = {
    "permit_num": "string", "status": "string", "structure_type": "string",
    "structure_category": "string", "construction_type": "string", "unit_form": "string",
    "exterior_visibility": "string", "road_class": "string", "proposed_use": "string",
    "description": "string", "dwelling_units_created": "int", "dwelling_units_lost": "int",
    "net_units_created": "int", "unit_bucket": "string", "full_address": "string",
    "ward": "string", "application_date": "date", "issued_date": "date",
    "completed_date": "date",
}
WARD_PROPERTIES = {"ward_code": "string", "ward_name": "string"}


SUMMARY_SCHEMA = (
    "last_updated string, "
    "totals_by_status array<struct<status: string, permit_count: bigint, net_units_created: bigint>>, "
    "unmatched_address_count bigint, earliest_application_date string, latest_application_date string"
)


def permit_features(housing: DataFrame) -> DataFrame:
    """One line per mapped permit; no units lost is written as null, dates as ISO text."""
    lost = F.nullif(F.col("dwelling_units_lost"), F.lit(0)).alias("dwelling_units_lost")
    properties = [
        lost if name == "dwelling_units_lost"
        else F.col(name).cast("string").alias(name) if kind == "date"
        else F.col(name)
        for name, kind in PERMIT_PROPERTIES.items()
    ]
    return housing.filter(F.col("geom").isNotNull()).select(feature("geom", properties).alias("value"))


def ward_features(wards: DataFrame) -> DataFrame:
    return wards.select(feature("geom", list(WARD_PROPERTIES)).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def read_features(spark: SparkSession, path: str, properties: dict[str, str]) -> DataFrame:
    """Features as rows again: the properties, and the geometry as JSON text in ``geom``."""
    fields = ", ".join(f"{name}: {kind}" for name, kind in properties.items())
    schema = f"struct<type: string, geometry: variant, properties: struct<{fields}>>"
    parsed = spark.read.text(path).select(F.from_json("value", schema).alias("f"))
    geom = F.when(~F.is_variant_null("f.geometry"), F.to_json("f.geometry"))
    return parsed.select("f.properties.*", geom.alias("geom"))


def summary_line(summary: DataFrame) -> DataFrame:
    return summary.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).json(path)
