"""Connected components of an edge table by union-find on parts of it.

Each task joins the nodes of at most ``EDGES_PER_TASK`` edges and reports every node with the
smallest node it reached. A node that several tasks reported under different names connects
these names: they are the edges of the next, much smaller round. A node is reported once per
task, so no key gathers more rows than there are tasks, however many neighbours it has. Edges
that fit one task need one round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import map_arrow, written

EDGES_PER_TASK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, and the smallest node that each is connected to."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        apart = low != high
        if not apart.any():
            return nodes, nodes[root]
        u, v = u[apart], v[apart]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, root[root]):
            root = root[root]


def _local(edges: DataFrame, tasks: int) -> DataFrame:
    def run(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if parts:
            node, root = forest(*(np.concatenate(c) for c in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "component"])

    dealt = edges.coalesce(1) if tasks == 1 else edges.repartition(tasks)
    return map_arrow(dealt, run, "node long, component long")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes of the edges; ids are not null."""
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    count = edges.count()
    tasks = max(1, -(-count // EDGES_PER_TASK))
    found = _local(edges, tasks)
    if tasks == 1:
        return found
    found = written(found, "forest")
    least = written(found.groupBy("node").agg(F.min("component").alias("component")), "forest-minima")
    between = (
        found.withColumnRenamed("component", "u").join(least, "node").filter("u != component")
        .select("u", F.col("component").alias("v")).distinct()
    )
    between = written(between, "forest-edges")
    above = components(between, "u", "v").select(F.col("node").alias("component"), F.col("component").alias("top"))
    return least.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
