"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import ship, stored, unstored

#: Edges that a task ties to stars at a time.
BLOCK = 1 << 18


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of the pairs (a, b); ``root`` points at the first row of a class before and after."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def _tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of edges as stars: every node tied to the smallest that the block's edges reach."""
    held, rows = [], 0

    def stars() -> pa.RecordBatch:
        a, b = (np.concatenate([batch.column(i).to_numpy() for batch in held]) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = np.arange(len(nodes))
        merge(root, at[:len(a)], at[len(a):])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield stars()
            held, rows = [], 0
    if rows:
        yield stars()


def tied(edges: DataFrame) -> DataFrame:
    """Fewer edges (``a`` > ``b``) with the same components; nothing is shuffled."""
    return edges.mapInArrow(_tied, "a long, b long")


def done(edges: DataFrame) -> bool:
    """Whether each node is tied to one that is tied to none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("low")), F.struct(
        F.col("b").alias("node"), F.lit(None).cast("long").alias("low")))).alias("end")).select("end.*")
    each = ends.groupBy("node").agg(F.min("low").alias("low"), F.max("low").alias("high"), F.count_if(F.col("low").isNull()).alias("under"))
    return each.agg(F.count_if((F.col("low") < F.col("high")) | F.col("low").isNotNull() & (F.col("under") > 0))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) with the smallest id of its component for every node of the edges (``a``, ``b``) but the roots.

    Tasks first tie the edges that they read to stars of their own, so that few long paths are left.  Then large-star and
    small-star steps in turn: every node ties its larger neighbours, then its smaller ones, to the smallest it knows.  Both
    are a minimum per node (combined map-side) joined back to the edges; each round is written out, so lineage stays
    short, and rounds grow with the logarithm of the longest path.
    """
    ship(edges.sparkSession)
    ordered = edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).where("a <> b")
    found = stored(tied(ordered), "edges")
    while True:
        current = stored(tied(found), "star")  # read in fewer and larger pieces than it was made in
        unstored(found)
        if done(current):
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), "star")
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        found = stored(small.where("a <> b").distinct(), "star")
        unstored(current, large)
    current = current.distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
