"""One row per key, and the most common value per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle, so a
    map task sends at most one row per key however many rows a hot key has.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def most_common(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent ``value`` per key, the alphabetically first one on ties.

    Counting (key, value) first combines on the map side; what is then compared per key is
    one row per distinct value.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value)))
    return counted.groupBy(*keys).agg(best.alias(value))
