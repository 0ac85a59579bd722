"""Token ids as directly addressable codes: any token is read without decoding its neighbours.

An id is split into chunks of ``CHUNK_BITS`` bits, least significant first. Level 0 holds the
first chunk of every id, level 1 the second chunk of the ids that have one, and so on. Per
level a bitmap says which of its ids go on, and a rank directory holds the number of set bits
before each block of ``RANK_BLOCK`` bits. Token ``i`` is chunk ``i`` of level 0; if its bit is
set, its next chunk stands at position ``rank(i)`` of level 1.

File format. A store is a folder of uncompressed Parquet files that Spark's writers commit, so
it works on any file system of the cluster and a lost executor leaves nothing behind. One row is
a segment: whole documents in ascending order, about ``SEGMENT_TOKENS`` tokens, or one longer
document. Columns: ``shard`` (ascending ranges of doc_id), ``segment``, ``first_token`` (within
the shard), ``n_tokens``, ``doc_ids``, ``doc_ends`` (end of each document within the segment) and
``levels``, an array of (chunks, bitmap, ranks) as little-endian bytes.

Order: ascending doc_id, null ids first; rows with equal ids by hash of the text, then the text.
A null text is empty and has the end id alone. Other columns are ignored. An empty table gives
an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.llm.common import map_arrow, width
from lotwise.llm.tokens import ENCODED_CHARS, encoder, end_marked, slices

CHUNK_BITS = 8
RANK_BLOCK = 512
SEGMENT_TOKENS = 1 << 18
# Stored segments cover several of these stretches of token positions; lookups join on them.
STRETCH = 1 << 20

SEGMENT_SCHEMA = (
    "shard int, segment long, first_token long, n_tokens long, doc_ids array<bigint>, doc_ends array<bigint>, "
    "levels array<struct<chunks: binary, bitmap: binary, ranks: binary>>"
)
LEVEL_TYPE = pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())])


def pack(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """The levels of unsigned integers; none for no ids."""
    levels, rest = [], ids.astype("<u4")
    while len(rest):
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        blocks = -(-len(rest) // RANK_BLOCK)
        padded = np.zeros(blocks * RANK_BLOCK, dtype=np.uint32)
        padded[: len(rest)] = goes_on
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(blocks, RANK_BLOCK).sum(axis=1))])
        chunks = (rest & ((1 << CHUNK_BITS) - 1)).astype("u1")
        levels.append((chunks.tobytes(), bitmap.tobytes(), ranks.astype("<u4").tobytes()))
        rest = more[goes_on]
    return levels


class Segment:
    """Reads the tokens of one segment."""

    def __init__(self, levels: list[dict]):
        self.levels = [
            (np.frombuffer(l["chunks"], "u1"), np.frombuffer(l["bitmap"], "u1"), np.frombuffer(l["ranks"], "<u4"))
            for l in levels
        ]

    def token(self, at: int) -> int:
        """One token: a chunk, a bit and a rank per level, whatever the segment's length."""
        value = 0
        for depth, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[at]) << (CHUNK_BITS * depth)
            if not bitmap[at >> 3] >> (at & 7) & 1:
                break
            block = at // RANK_BLOCK
            begin = block * RANK_BLOCK // 8
            before = np.unpackbits(bitmap[begin : (at >> 3) + 1], bitorder="little")[: at - block * RANK_BLOCK]
            at = int(ranks[block]) + int(before.sum())
        return value

    def rank(self, depth: int, at: int) -> int:
        _, bitmap, ranks = self.levels[depth]
        block = at // RANK_BLOCK
        begin = block * RANK_BLOCK // 8
        before = np.unpackbits(bitmap[begin : (at >> 3) + 1], bitorder="little")[: at - block * RANK_BLOCK]
        return int(ranks[block]) + int(before.sum())

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Tokens ``begin`` to ``end``: on each level the chunks between two ranks."""
        out = np.zeros(max(0, end - begin), dtype="<u4")
        place, depth = np.arange(len(out)), 0
        while len(place):
            chunks, bitmap, _ = self.levels[depth]
            out[place] |= chunks[begin:end].astype("<u4") << np.uint32(CHUNK_BITS * depth)
            bits = np.unpackbits(bitmap[begin >> 3 : ((end - 1) >> 3) + 1], bitorder="little")
            goes_on = bits[begin & 7 : (begin & 7) + end - begin].astype(bool)
            place = place[goes_on]
            if len(place):
                begin = self.rank(depth, begin)
                end = begin + len(place)
            depth += 1
        return out


def _segment_rows(docs: Iterator[tuple[int, bytes]], shard: int) -> Iterator[pa.RecordBatch]:
    """Segments of consecutive documents, numbered and placed within the shard."""

    def flush(segment: int, first: int, doc_ids: list, parts: list[bytes]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(parts), "<u4")
        ends = np.cumsum([len(p) // 4 for p in parts])
        levels = [{"chunks": c, "bitmap": b, "ranks": r} for c, b, r in pack(ids)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()), pa.array([segment], pa.int64()), pa.array([first], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([levels], pa.list_(LEVEL_TYPE)),
            ],
            ["shard", "segment", "first_token", "n_tokens", "doc_ids", "doc_ends", "levels"],
        )

    segment, first, doc_ids, parts, size = 0, 0, [], [], 0
    for doc_id, ids in docs:
        if parts and size + len(ids) // 4 > SEGMENT_TOKENS:
            yield flush(segment, first, doc_ids, parts)
            segment, first, doc_ids, parts, size = segment + 1, first + size, [], [], 0
        doc_ids.append(doc_id)
        parts.append(ids)
        size += len(ids) // 4
    if parts:
        yield flush(segment, first, doc_ids, parts)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every text, add ``end_id``, and write the store to a new folder.

    The texts are dealt out by ranges of (doc_id, hash of the text), so that rows that share
    an id do not meet in one task, sorted, and encoded in that order: no text or id list is
    shuffled twice. The bounds of the ranges are sampled from the scan; they decide only
    which shard holds a row.
    """
    tie = F.xxhash64("text")
    rows = (
        docs.select("doc_id", "text", tie.alias("tie"))
        .repartitionByRange(width(docs.sparkSession), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )

    def run(batches):
        from pyspark import TaskContext

        encode = encoder(tokenizer).encode

        def encoded():
            for batch in batches:
                doc_ids = batch.column(0).to_pylist()
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for lo, hi in slices(texts, ENCODED_CHARS, 2000):
                    for doc_id, ids in zip(doc_ids[lo:hi], encode(texts[lo:hi])):
                        yield doc_id, end_marked(ids, end_id)

        yield from _segment_rows(encoded(), TaskContext.get().partitionId())

    map_arrow(rows, run, SEGMENT_SCHEMA, remembers=True).write.option("compression", "uncompressed").parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The store's rows with ``start``, the number of tokens in all segments before.

    Only the tokens of each shard are summed on the driver: one number per range of the write.
    """
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = {r["shard"]: r["n"] for r in stored.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    bases, before = [], 0
    for shard in sorted(totals):
        bases.append((shard, before))
        before += totals[shard]
    base = spark.createDataFrame(bases, "shard int, base long")
    return stored.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("first_token")).drop("base")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document read back: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = Segment(row["levels"]).slice(0, row["n_tokens"]) if row["n_tokens"] else np.zeros(0, "<u4")
                ends = np.array(row["doc_ends"], dtype=np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["start"]), pa.array(ends - begins),
                        pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    rows = segments(spark, path).select("start", "n_tokens", "doc_ids", "doc_ends", "levels")
    return map_arrow(rows, run, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """``position`` (counted over the whole store) and ``token``; positions outside give no row.

    Positions and segments meet on the stretches of the store they lie in; within a segment
    each token costs one chunk, bit and rank per level.
    """
    stretch = F.sequence(F.floor(F.col("start") / STRETCH), F.floor((F.col("start") + F.col("n_tokens") - 1) / STRETCH))
    covered = segments(spark, path).filter("n_tokens > 0").select("start", "n_tokens", "levels", F.explode(stretch).alias("stretch"))
    wanted = positions.select(F.col("position"), F.floor(F.col("position") / STRETCH).alias("stretch"))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))
    rows = wanted.join(covered, "stretch").filter(inside).select("position", "start", "levels")

    def run(batches):
        for batch in batches:
            found = [Segment(r["levels"]).token(r["position"] - r["start"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["position", "token"])

    return map_arrow(rows, run, "position long, token long")


def with_crc32(docs: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``ids``."""
    return docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
