"""Values at given ranks of a whole-number column, exactly, without sorting it in one place.

Rows are first reduced to (value, count) pairs. A rank is then narrowed down like a radix sort does
it, sixteen bits of the value at a time: the pairs below the prefix that is known so far are added up
by the next sixteen bits, and a running sum over these, of which there are 65,536 at most, says which
one holds the rank. After four steps the value is known. No task holds more than the sums below one
prefix, and no more than one prefix per wanted rank goes on, however many rows and values there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BITS = 16


def counted(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """How often each whole number occurs in each group; rows without value or group are left out.

    The value is declared never to be null: joins by it then add no filter of their own, so all
    steps share one shuffle of the pairs.
    """
    number = F.coalesce(F.col(value).cast("bigint"), F.lit(0))
    return df.dropna(subset=[*by, value]).groupBy(*by, number.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def with_one_row(df: DataFrame, row: DataFrame, by: list[str]) -> DataFrame:
    """Add the columns of a frame that has one row per group, or one row in all."""
    if by:
        return df.join(row, by)
    return df.withColumns({c: row.select(c).scalar() for c in row.columns})


def values_at(pairs: DataFrame, by: list[str], wanted: Column) -> DataFrame:
    """``found``: an array of (rank, value) of the wanted ranks, a row per group or one row in all.

    ``pairs`` has ``by``, ``value`` and ``n``; ``wanted`` is an array of ranks from 0, made from the
    group's total ``n``. A rank that there is not is left out.
    """
    # What goes on to the next step: the ranks, how far each lies behind the start of the prefix that
    # is known to hold it, and that prefix. A handful per group.
    first = F.transform(
        F.array_distinct(wanted), lambda r: F.struct(r.alias("rank"), r.alias("rest"), F.lit(0).cast("bigint").alias("known"))
    )
    found = pairs.groupBy(*by).agg(F.sum("n").alias("n")).select(*by, first.alias("places"))
    for shift in range(64 - BITS, -1, -BITS):
        known = F.lit(0).cast("bigint") if shift == 64 - BITS else F.shiftright("value", shift + BITS)
        steps = pairs.select(*by, known.alias("known"), F.shiftright("value", shift).alias("prefix"), "n")
        # Only what lies below a prefix that holds a wanted rank goes on.
        below = with_one_row(steps, found, by).filter(F.exists("places", lambda p: p["known"] == F.col("known")))
        sums = below.groupBy(*by, "known", "prefix").agg(F.sum("n").alias("n"), F.any_value("places").alias("places"))
        sums = sums.withColumn("after", F.sum("n").over(Window.partitionBy(*by, "known").orderBy("prefix")))
        before = F.col("after") - F.col("n")
        inside = F.filter(
            "places", lambda p: (p["known"] == F.col("known")) & (p["rest"] >= before) & (p["rest"] < F.col("after"))
        )
        moved = F.transform(
            inside, lambda p: F.struct(p["rank"].alias("rank"), (p["rest"] - before).alias("rest"), F.col("prefix").alias("known"))
        )
        found = (
            sums.select(*by, moved.alias("places")).filter(F.size("places") > 0)
            .groupBy(*by).agg(F.flatten(F.collect_list("places")).alias("places"))
        )
    each = F.transform("places", lambda p: F.struct(p["rank"].alias("rank"), p["known"].alias("value")))
    return found.select(*by, each.alias("found"))


def quantiles(df: DataFrame, value: str, shares: list[float], by: list[str] = ()) -> DataFrame:
    """``quantiles``: the exact ones of a whole-number column, linear between neighbours, an array of
    doubles per group; a row for each group that has a value."""
    by = list(by)
    pairs = counted(df, value, by)
    position = [(F.col("n") - 1) * F.lit(float(share)) for share in shares]
    low, high = [[end(p).cast("bigint") for p in position] for end in (F.floor, F.ceil)]
    doubles = F.transform("found", lambda f: F.struct(f["rank"].alias("rank"), f["value"].cast("double").alias("value")))
    known = values_at(pairs, by, F.array(*low, *high)).select(*by, F.map_from_entries(doubles).alias("at"))
    joined = with_one_row(pairs.groupBy(*by).agg(F.sum("n").alias("n")), known, by)
    between = [
        F.when(a == b, F.element_at("at", a)).otherwise((b - p) * F.element_at("at", a) + (p - a) * F.element_at("at", b))
        for p, a, b in zip(position, low, high)
    ]
    return joined.select(*by, F.array(*between).alias("quantiles"))
