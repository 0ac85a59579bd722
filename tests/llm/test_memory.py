"""Memory of Python workers: what is freed goes back to the system while a task runs."""

from __future__ import annotations

import ctypes
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm.common import map_arrow

MB = 1 << 20


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library cannot be asked to trim")
def test_memory_freed_after_a_batch_is_returned_before_the_next(spark):
    def run(batches):
        kept = []
        for batch in batches:
            with open("/proc/self/statm") as file:
                resident = int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
            # Blocks below the size that is mapped by itself, each held down by a small one above it.
            both = [(b"x" * 100_000, b"y" * 1000) for _ in range(2000)]
            kept += [small for _, small in both]
            del both
            yield pa.RecordBatch.from_arrays([pa.array([resident])], ["resident"])

    texts = spark.range(0, 4, 1, 1).select(F.repeat(F.lit("x"), 17 * MB).alias("text"))
    resident = [r["resident"] for r in map_arrow(texts, run, "resident long").collect()]
    assert len(resident) == 4
    # The first batch finds none of the blocks; a batch itself may be held twice.
    assert max(resident[1:]) - resident[0] < 100 * MB
