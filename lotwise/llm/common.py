"""What the operators of this subpackage share: input columns, worker memory, stored steps."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

import lotwise
from lotwise.session import scratch_path, shuffle_width

ARROW_BYTES = 16 << 20
# Input after which a worker gives freed memory back to the system.
RETURN_BYTES = 4 << 20
LETTERS_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_LOW = LETTERS_UP.lower()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType,
    remembers: bool = False, batch_bytes: int = ARROW_BYTES,
) -> DataFrame:
    """``mapInArrow`` whose functions reach workers that cannot import this package.

    Batches are limited in bytes as well as in rows, so that a run of very long texts does
    not have to fit a worker's memory at once. Workers go from one stage to the next: a stage
    that does not itself remember objects drops what stages before have left in them. Spark reads
    the limit when the rows are computed: one of its own holds if these are written at once.
    """
    cloudpickle.register_pickle_by_value(lotwise)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))

    def task(batches):
        if not remembers:
            worker_store().clear()
            return_memory()
        try:
            yield from run(_returning(batches))
        finally:
            return_memory()

    return df.mapInArrow(task, schema)


def return_memory() -> None:
    """Gives memory that Arrow and the C library hold but do not use back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _returning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; freed memory is returned as they go by, not only when all are done."""
    size = 0
    for batch in batches:
        size += batch.nbytes
        yield batch
        del batch
        if size >= RETURN_BYTES:
            return_memory()
            size = 0


def worker_store() -> dict:
    """Objects that live in this Python worker from task to task, while stages remember."""
    return sys.__dict__.setdefault("_lotwise_worker_store", {})


def kept(key: tuple, build: Callable):
    """The object of this worker under ``key``, built at its first use."""
    store = worker_store()
    if key not in store:
        store[key] = build()
    return store[key]


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows from a new folder in the shared folder: computed once, read many times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    return shuffle_width(spark)


def free_prefix(columns: list[str], prefix: str) -> str:
    """The prefix, with as many underscores before it as it takes to meet no column's name."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = f"_{prefix}"
    return prefix


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, LETTERS_UP, LETTERS_LOW)


def doc_remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


# Bits of an id filter: 4 MB, whatever the number of ids; more ids only let more rows through.
FILTER_BITS = 1 << 25


def id_filter(ids: DataFrame) -> bytes:
    """A bitmap with a bit for the hash of each value of the only column, null included.

    Rows whose bit is not set need not be shuffled to meet these ids. Spark builds it in rows
    of 4 KB, 4 MB in all.
    """
    at = F.pmod(F.xxhash64(ids.columns[0]), F.lit(FILTER_BITS)) + 1
    rows = (
        ids.select(at.alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
        .collect()
    )
    whole = bytearray(FILTER_BITS // 8)
    for row in rows:
        start = (row["bucket"] - 1) * len(row["bits"])
        whole[start : start + len(row["bits"])] = row["bits"]
    return bytes(whole)


def passing(batch: pa.RecordBatch, column: str, bits: bytes) -> pa.RecordBatch:
    """The rows of a batch whose hash, in ``column``, has its bit set."""
    at = batch.column(column).to_numpy() % FILTER_BITS
    return batch.filter(pa.array((np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7)) & 1 == 1))
