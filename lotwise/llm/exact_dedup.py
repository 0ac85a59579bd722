"""Exact duplicates after lower-casing A-Z, with frequent texts taken out of the shuffle.

1. Every row's digest (SHA-256 of the normalised text) and a row number are written once; later
   steps read 48 bytes a row instead of the texts.
2. Frequent-items sketches of the Misra-Gries family, one per group of map tasks, name the
   digests that may hold more than 1 of ``HEAVY`` rows. A sketch errs, so each named digest is
   counted exactly, with partial counts before the shuffle, and kept as heavy only if it holds
   more than one row.
3. The verified winners of heavy digests, at most ``HEAVY`` rows, are broadcast: their rows are
   settled where they are read.
4. All other digests go through one ordinary shuffle. No group there is large, as a large one
   would be heavy.

Null text counts as empty. Of equal texts the row with the largest doc_id stays; a null id is
smaller than any other. If several rows share text and id, all of them name that id as the one
that stays and exactly one, any of these equal rows, is kept. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.llm.common import ascii_lower, free_prefix, written

# Most heavy digests, counters per sketch, and groups of map tasks that share a sketch.
HEAVY = 1024
SKETCH_COUNTERS = 8192
SKETCH_GROUPS = 256


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def heavy_digests(rows: DataFrame) -> DataFrame:
    """Digests that a sketch holds to be frequent: every one with more than 1 in ``HEAVY`` rows.

    Rows of a sketch are ``SKETCH_GROUPS`` at most, so the named digests are bounded; the sum
    over groups keeps those whose counts may pass the share.
    """
    sketches = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(hex(digest), {HEAVY}, {SKETCH_COUNTERS})").alias("top"),
    )
    # A digest above the share overall is above it in at least one group.
    named = sketches.select("rows", F.explode("top").alias("t")).select("rows", "t.item", "t.count")
    return (
        named.filter(F.col("count") * 2 * HEAVY > F.col("rows"))
        .groupBy("item").agg(F.sum("count").alias("n"))
        .filter("n > 1").orderBy(F.desc("n"), "item").limit(HEAVY)
        .select(F.unhex("item").alias("digest"))
    )


def resolve(docs: DataFrame) -> DataFrame:
    """All rows: doc_id, digest, keep_id, group_size, kept."""
    # The row to keep among equal texts and ids is picked by its place, which is stored: numbers made
    # anew by each job would change with the number of cores that Spark packs files for.
    placed = written(
        docs.select("doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("place")), "digests"
    )
    named = F.broadcast(heavy_digests(placed))
    best = F.max(F.struct("doc_id", "place"))
    winners = written(
        placed.join(named, "digest", "leftsemi").groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")),
        "heavy-winners",
    )
    light = placed.join(F.broadcast(winners.select("digest")), "digest", "leftanti")
    by_digest = Window.partitionBy("digest")
    light = light.withColumns({"best": best.over(by_digest), "group_size": F.count(F.lit(1)).over(by_digest)})
    settled = placed.join(F.broadcast(winners), "digest").select(light.columns)
    return settled.unionByName(light).select(
        "doc_id", "digest", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("place") == F.col("best.place")).alias("kept"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows come back by (doc_id, digest); of equal rows with one id, one is taken.
    """
    # Rows and decisions meet on plain columns, so that one shuffle of the texts serves both
    # the join and the choice among repeated rows.
    on = [f"{free_prefix(docs.columns, '_dedup')}_{name}" for name in ("id", "no_id", "digest")]
    keys = [F.coalesce("doc_id", F.lit(0)).alias(on[0]), F.col("doc_id").isNull().alias(on[1]), F.col(on[2])]
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = resolve(docs).filter("kept").select("doc_id", F.col("digest").alias(on[2])).select(*keys)
    marked = docs.withColumn(on[2], digest(F.col("text"))).select(*names, *keys)
    return marked.join(kept, on, "leftsemi").dropDuplicates(on).select(*names)
