"""Whitening of embedding vectors, from exact sums and an orthogonal reduction, never a covariance.

Entries become whole numbers, ``floor(64 c) + 1000000``. The fit list holds each distinct vector of
these once, so copies carry no weight. Its sums per dimension are exact integers; a centred entry is
(n x - S) / n, whose numerator is exact. Every task reduces its centred rows block by block to a
small triangle R by QR, triangles are reduced by QR in rounds of ``FAN_IN``, and the last one stands
for all rows: R'R is n times their covariance, without ever being squared. ``bidiagonal`` finds its
largest singular values and right vectors: the components. A component is unit length, numbered from
1 by falling variance e, and its first entry of largest size is positive. Whitened coordinates are
the centred vector's projections over sqrt(e). How far their covariance over the fit list is from
the identity is measured on all its vectors, and reported.

Work. Distinct vectors are found by one shuffle of whole vectors, combined before it, so a vector that
makes up a third of all rows is sent once per task. Everything else moves rows of one vector's width,
or triangles: a few per task, whatever the number of vectors. The driver gets the sums, one triangle
and the measured covariance.

Defined results. Rows whose vector is null, empty, or has null or non-finite entries, or entries too
large for their whole number to be exact (2^46 and more), are dropped. If lengths differ, the most
frequent length among distinct vectors counts (the longest of equally frequent ones) and rows of other
lengths are dropped. Rows that remain, repeated ones and null ids included, are all returned.
Components without variance (below ``RANK`` of the largest, by singular value) cannot be whitened and
are left out; without any component, as for a single distinct vector or an empty table, there are no
rows. Equal variances: any directions within their space, the same for all rows. Other columns of the
table are ignored. A deviation beyond 64 bits is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.bidiagonal import right_singular
from lotwise.llm.common import map_arrow, written

MOST = 16
# Entries are counted in steps of 1/64 from -15625.
STEPS, ZERO = 64, 1_000_000
LARGEST = 2.0**46
RANK = 1e-11
FAN_IN = 32
BLOCK_ROWS = 4096


def whole_entries(vector: str = "embedding") -> Column:
    """The vector as whole numbers, or null if it has to be dropped."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    usable = F.forall(wide, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    kept = F.when(usable & (F.size(wide) > 0), wide)
    return F.transform(kept, lambda c: F.floor(c * STEPS) + F.lit(ZERO).cast("bigint"))


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct ``x`` of the most frequent length, stored."""
    distinct = written(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    lengths = distinct.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return distinct.filter(F.size("x") == (best["length"] if best else 0))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Model:
    """Size and exact sums of the fit list; directions as columns, their variances, and the total."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x * self.n - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        gap = x * self.n - self.sums
        if len(gap) and (gap.astype(float) ** 2).sum(axis=1).max() > 9.2e18:
            raise OverflowError("a deviation does not fit 64 bits")
        return (gap * gap).sum(axis=1)


def exact_sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sum per dimension, over all of the fit list."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), len(batch.column(0)[0]))
                total = np.concatenate([[len(x)], x.sum(axis=0)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    rows = map_arrow(fit, run, "place long, value long").groupBy("place").agg(F.sum("value").alias("value"))
    total = [row["value"] for row in rows.orderBy("place").collect()]
    return (total[0], np.array(total[1:], np.int64)) if total else (0, np.zeros(0, np.int64))


def triangle(blocks) -> np.ndarray | None:
    """R of all rows of all blocks, one block at a time under the triangle so far."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.concatenate([r, block]), "r")
    return r


def _triangles(rows: DataFrame, take, d: int) -> DataFrame:
    """One triangle per task, as bytes; ``take`` makes the blocks of rows of a batch."""

    def run(batches):
        r = triangle(block for batch in batches if batch.num_rows for block in take(batch))
        if r is not None:
            square = np.zeros((d, d))
            square[: len(r)] = r
            yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()], pa.binary())], ["r"])

    return map_arrow(rows, run, "r binary")


def reduced(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle that stands for all centred rows of the fit list."""
    d, seed = len(sums), Model(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0)

    def centred_blocks(batch):
        x = _matrix(batch.column(0), d)
        for begin in range(0, len(x), BLOCK_ROWS):
            yield seed.centred(x[begin : begin + BLOCK_ROWS])

    def stacked(batch):
        for r in batch.column(0):
            yield np.frombuffer(r.as_py()).reshape(d, d)

    parts = written(_triangles(fit, centred_blocks, d), "triangles")
    count = parts.count()
    while count > 1:
        count = -(-count // FAN_IN)
        parts = _triangles(parts.repartition(count), stacked, d)
    return np.frombuffer(parts.first()["r"]).reshape(d, d)


def _identity_error(fit: DataFrame, model: Model) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured."""
    k = len(model.variances)

    def run(batches):
        total = np.zeros(k + k * k)
        for batch in batches:
            z = model.whitened(_matrix(batch.column(0), len(model.sums)))
            total += np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    rows = map_arrow(fit, run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.array([row["value"] for row in rows.orderBy("place").collect()]) / model.n
    mean = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def learn(rows: DataFrame, most: int = MOST) -> Model | None:
    """A model from the column ``x`` of whole entries; None if there is nothing to whiten."""
    fit = fit_list(rows)
    n, sums = exact_sums(fit)
    if n < 2:
        return None
    r = reduced(fit, n, sums)
    squares, directions = right_singular(r, most)
    some = squares > RANK**2 * max(squares.max(initial=0.0), 0.0)
    if not some.any():
        return None
    squares, directions = squares[some], directions[:, some]
    directions = directions / np.linalg.norm(directions, axis=0)
    lead = directions[np.abs(directions).argmax(axis=0), np.arange(len(squares))]
    model = Model(n, sums, directions * np.sign(lead), squares / n, float((r * r).sum() / n))
    model.identity_error = _identity_error(fit, model)
    return model


WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, most: int = MOST) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding) that remains, a row per component."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_entries().alias("x")).filter("x IS NOT NULL")
    model = learn(rows, most)
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    k, d = len(model.variances), len(model.sums)
    explained = model.variances / model.total

    def run(batches):
        for batch in batches:
            x, m = _matrix(batch.column(1), d), batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                    pa.array(np.repeat(model.deviations(x), k)), pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_arrow(rows.filter(F.size("x") == d), run, WHITENED)
