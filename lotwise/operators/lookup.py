"""Left joins that stay balanced when keys are missing or hot.

No side is forced to be broadcast: Spark does that itself when the size it knows or, at run
time, the size it has measured is below ``spark.sql.autoBroadcastJoinThreshold``. The rest
is about the shuffled join. A salt takes part in the key:

* rows with a missing key match nothing, so any salt will do and they are spread out;
* a hot key has as many salts as it fills shares of a partition: its rows are spread over these,
  and the few lookup rows of that key are repeated once per salt of that key alone;
* every other row has salt 0, on both sides.

How many salts a key gets is measured (``salts``) if the caller asks for it. A wrong measure could
only cost balance: the rows of the result are the same for any keys and any numbers of salts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.session import shuffle_width

SALT = "_salt"
# Shares that a partition is thought to have: a key that fills one of them is hot.
SHARES = 2


def all_present(columns: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def key_digest(keys: list[str]) -> Column:
    """A single bigint key stands for itself, several columns for their hash."""
    if len(keys) == 1:
        return F.col(keys[0])
    return F.when(all_present(keys), F.xxhash64(*keys))


def key_counts(df: DataFrame, keys: dict[str, list[str]]) -> tuple[int, dict[str, dict[int, int]]]:
    """The number of rows, and for each named key its most frequent digests with their counts.

    One pass over the key columns without a shuffle of rows: a frequent-items sketch per key
    and group of map tasks, whose few entries are then added up. All sizes follow the number of
    shuffle partitions; two keys per partition can be hot at most, so as many numbers per name
    reach the driver.
    """
    width = shuffle_width(df.sparkSession)
    most = SHARES * width
    counters = max(4096, 8 * most)
    digests = df.select(
        F.pmod(F.spark_partition_id(), F.lit(width)).alias("_group"),
        *[key_digest(columns).alias(name) for name, columns in keys.items()],
    )
    sketches = digests.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"approx_top_k({name}, {most}, {counters})").alias(name) for name in keys],
    )

    def entries(name: str) -> Column:
        return F.transform(name, lambda e: F.struct(F.lit(name).alias("name"), e["item"].alias("item"), e["count"].alias("n")))

    total = F.array(F.struct(F.lit("_rows").alias("name"), F.lit(0).cast("bigint").alias("item"), F.col("_rows").alias("n")))
    top = (
        sketches.select(F.explode(F.concat(total, *[entries(name) for name in keys])).alias("e"))
        .groupBy("e.name", "e.item").agg(F.sum("e.n").alias("n"))
        .withColumn("place", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n"), "item")))
        .filter(F.col("place") <= most)
        .collect()
    )
    rows = sum(t["n"] for t in top if t["name"] == "_rows")
    return rows, {name: {t["item"]: t["n"] for t in top if t["name"] == name and t["item"] is not None} for name in keys}


def salts(df: DataFrame, keys: dict[str, list[str]]) -> dict[str, dict[int, int]]:
    """For each named key, the digests that fill more than a share of a partition, each with as
    many salts as it fills shares."""
    width = shuffle_width(df.sparkSession)
    rows, counts = key_counts(df, keys)
    return {
        name: {item: -(-n * SHARES * width // rows) for item, n in sorted(found.items()) if n * SHARES * width > rows}
        for name, found in counts.items()
    }


def hot_keys(df: DataFrame, keys: dict[str, list[str]]) -> dict[str, list[int]]:
    """For each named key, the digests that hold more than half a partition's fair share."""
    return {name: list(found) for name, found in salts(df, keys).items()}


Salts = Mapping[int, int] | Iterable[int]


def numbers_of_salts(given: Salts, width: int) -> dict[int, int]:
    """Salts by key; keys without a number get one salt per shuffle partition."""
    return dict(given) if isinstance(given, Mapping) else dict.fromkeys(given, width)


def salts_of(digest: Column, given: dict[int, int]) -> Column:
    """The number of salts of a key: 1 for all that are not hot. Keys of one number are one set."""
    sets: dict[int, list[int]] = {}
    for item, n in given.items():
        if n > 1:
            sets.setdefault(n, []).append(item)
    number = F.lit(1)
    for n, items in sorted(sets.items()):
        number = F.when(digest.isin(items), F.lit(n)).otherwise(number)
    return number


def spread(columns: list[str], number: Column) -> Column:
    """A salt below ``number`` that follows from a row's content, so it is the same whenever the
    row's task is run again."""
    return F.pmod(F.xxhash64(*columns), number.cast("bigint")).cast("int")


def every(number: Column) -> Column:
    return F.sequence(F.lit(0), number - 1)


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    row_id: list[str],
    hot: Salts = (),
    repeated: Salts = (),
) -> DataFrame:
    """``left`` join on equal keys; all rows of ``left`` stay, missing keys match nothing.

    ``row_id`` names columns that tell left rows apart. ``hot`` are digests that are frequent on
    the left. ``repeated`` are key values that hold many rows on the *right* (one key column
    only): there the right rows are spread and the left rows repeated. A left row with such a key
    has a match for certain, so its copies that met none are dropped.
    """
    width = shuffle_width(left.sparkSession)
    digest = key_digest(on)
    number = salts_of(digest, numbers_of_salts(hot, width))
    values = [c for c in right.columns if c not in on]
    repeated = numbers_of_salts(repeated, width)
    is_repeated, copies = F.lit(False), F.lit(1)

    if repeated:
        if len(on) != 1:
            raise ValueError("repeated keys need a single key column")
        is_repeated = F.coalesce(F.col(on[0]).isin(list(repeated)), F.lit(False))
        copies = salts_of(digest, repeated)
        right = _collapse_copies(right, is_repeated)
        values.append("_copies")

    one_salt = spread(row_id, F.when(digest.isNull(), F.lit(width)).otherwise(number))
    salted_left = (
        left.withColumn(SALT, F.explode(F.when(is_repeated, every(copies)).otherwise(F.array(one_salt))))
        if repeated
        else left.withColumn(SALT, one_salt)
    )
    joined = salted_left.join(salted(right.filter(all_present(on)), digest, number, is_repeated, copies), [*on, SALT], "left").drop(SALT)
    if repeated:
        joined = (
            joined.filter(~is_repeated | F.col("_met"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)))))
            .drop("_copy")
        )
    return joined.select(*left.columns, *[v for v in values if v != "_copies"])


def salted(right: DataFrame, digest: Column, number: Column, is_repeated: Column, copies: Column) -> DataFrame:
    """Lookup rows, those of a hot key once per salt of that key; rows of a repeated key are spread.

    Exploded even when there is one salt: a literal would be folded out of the join key.
    """
    right_salts = F.when(is_repeated, F.array(spread(right.columns, copies))).otherwise(every(number))
    return right.withColumn(SALT, F.explode(right_salts)).withColumn("_met", F.lit(True))


def fetch(left: DataFrame, right: DataFrame, on: str, row_id: list[str], left_salts: Column, right_salts: Column) -> DataFrame:
    """``left`` join by a number that is unique on the right, with the caller's own salts.

    A row's ``left_salts`` must not be more than the ``right_salts`` of the row it refers to.
    """
    width = shuffle_width(left.sparkSession)
    salt = spread(row_id, F.when(F.col(on).isNull(), F.lit(width)).otherwise(left_salts))
    copies = right.withColumn(SALT, F.explode(every(right_salts)))
    joined = left.withColumn(SALT, salt).join(copies, [on, SALT], "left")
    return joined.select(*left.columns, *[c for c in right.columns if c != on])


def _collapse_copies(right: DataFrame, is_repeated: Column) -> DataFrame:
    """Equal rows of a repeated key become one row with a count, combined before the shuffle."""
    once = right.filter(~is_repeated).withColumn("_copies", F.lit(1))
    many = right.filter(is_repeated).groupBy(*right.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    return once.unionByName(many)
