"""Landed pages of an open-data API: one JSON document per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lotwise.schemas import text_schema


CORRUPT = "_unreadable_page"


def page_schema(columns: list[str]) -> T.StructType:
    """Only the wanted fields; numbers and objects arrive as their JSON text."""
    records = T.ArrayType(text_schema(columns))
    return T.StructType(
        [
            T.StructField("success", T.BooleanType()),
            T.StructField("result", T.StructType([T.StructField("records", records)])),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


def read_pages(spark: SparkSession, path: str, columns: list[str], multi_line: bool = False) -> DataFrame:
    """All records of all pages below a path.

    A page that reports no success, has no list of records, or holds anything but objects in
    it, is an error that names the file: no page and no record is lost in silence.

    A page is one line of JSON, so files of many pages can be split; ``multi_line`` reads
    pretty-printed pages, one per file. A field a record does not have is NULL, a field
    nobody asked for is never read.
    """
    pages = spark.read.schema(page_schema(columns)).json(path, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT)

    def failed(reason: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{reason}: "), F.input_file_name())).cast("boolean")

    good = (
        F.when(~F.coalesce("success", F.lit(False)), failed("page without success"))
        .when(F.col(CORRUPT).isNotNull(), failed("unreadable page"))
        .when(F.col("result.records").isNull(), failed("page without records"))
        .when(F.exists("result.records", lambda r: r.isNull()), failed("record that is no object"))
        .otherwise(F.lit(True))
    )
    return pages.filter(good).select(F.inline("result.records"))
