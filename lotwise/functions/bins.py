"""Five quantile bins with cut points that strictly increase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.clean import col
from lotwise.operators.ranks import quantiles

# The quantiles at which the bins start.
BIN_STARTS = [0.0, 0.2, 0.4, 0.6, 0.8]


def increasing(cuts: Column | str) -> Column:
    """Lift each cut that is not above the one before it to one more than that."""
    cuts = col(cuts)
    last = lambda done: F.element_at(done, -1)
    lift = lambda done, cut: F.concat(
        done, F.array(F.when(cut <= last(done), last(done) + 1).otherwise(cut))
    )
    return F.aggregate(F.slice(cuts, 2, len(BIN_STARTS) - 1), F.slice(cuts, 1, 1), lift)


def cut_points(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """``cuts`` over the exact, linearly interpolated quantiles of a whole-number column.

    One row, or one per group. The ranks are selected step by step over (value, count) pairs, so
    no task sees the whole distribution.
    """
    none = F.array(*[F.lit(0.0) for _ in BIN_STARTS])
    found = F.when(F.exists("quantiles", lambda q: q.isNull()), none).otherwise(F.col("quantiles"))
    return quantiles(df, value, BIN_STARTS, by).select(*by, increasing(found).alias("cuts"))


def bin_index(value: Column | str, cuts: Column | str) -> Column:
    """Number of the highest cut that is not above the value; values below all are in bin 0."""
    reached = F.size(F.filter(col(cuts), lambda cut: cut <= col(value)))
    return F.greatest(reached - 1, F.lit(0))


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5)


def bin_edges(cuts_and_top: DataFrame) -> DataFrame:
    """(bin, low, high, is_open) from one row of ``cuts`` and ``top`` (the largest value)."""
    cut_rows = cuts_and_top.select("cuts", "top", F.posexplode("cuts").alias("bin", "cut"))
    last = F.col("bin") == F.size("cuts") - 1
    following = F.try_element_at(F.col("cuts"), F.col("bin") + 2)
    return cut_rows.select(
        "bin",
        half_up(F.col("cut")).alias("low"),
        F.when(last, half_up(F.col("top").cast("double"))).otherwise(half_up(following - 1)).alias("high"),
        last.alias("is_open"),
    )
