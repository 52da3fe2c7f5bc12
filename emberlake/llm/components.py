"""Connected components of an edge table by alternating star contraction.

Each round links every node's larger neighbours to its least neighbour, then
does the same for the smaller ones; the edges become stars around the least
node of each component in a logarithmic number of rounds.  A node's least
neighbour is a pre-aggregated minimum, so a node with a third of all edges is
not gathered anywhere; the join that brings it back reads stored tables whose
skewed partitions Spark splits.  Each round ends in a stored table.  A graph that is counted
and found to have at most ``ONE_TASK_EDGES`` edges is solved in one task by
label propagation with pointer jumping; the answer is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import staged, with_code

ONE_TASK_EDGES = 100_000


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("v").agg(F.min("u").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("v", "u").unionAll(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = _least(both).select("v", F.least("v", "least").alias("least"))
    larger = both.filter("u > v").join(staged(least, "cc-least"), "v")
    return larger.select(F.col("u").alias("v"), F.col("least").alias("u")).filter("u < v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from a larger node v to a smaller node u."""
    least = staged(_least(edges), "cc-least")
    moved = edges.join(least, "v").select(F.col("u").alias("v"), F.col("least").alias("u"))
    return moved.unionAll(least.select("v", F.col("least").alias("u"))).filter("u < v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))")).first())


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of a small graph."""
    pairs = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    if pairs:
        names, ends = np.unique(np.concatenate(pairs, axis=1), return_inverse=True)
        v, u = ends.reshape(2, -1)
        label, before = np.arange(len(names)), None
        while before is None or (label != before).any():
            before = label.copy()
            least = np.minimum(label[v], label[u])
            np.minimum.at(label, v, least)
            np.minimum.at(label, u, least)
            label = label[label]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[label])], names=["node", "root"])


def components(edges: DataFrame, max_rounds: int = 50, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, root) for every node of ``edges`` (whole numbers v, u): the
    root is the least node of its component.  No edges give no rows."""
    with_code(edges.sparkSession)
    edges = staged(edges.filter("v != u").select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct(),
                   "cc-edges")
    mark = _mark(edges)
    if mark[0] <= one_task_edges:
        return edges.select("v", "u").coalesce(1).mapInArrow(_solve, "node long, root long")
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        edges = staged(_small_star(staged(_large_star(edges), "cc-large")), "cc-edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root")))
