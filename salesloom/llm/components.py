"""Connected components of a graph whose edges stay in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import kept, shipped

#: So many edges of a task are tied up at once.
CHUNK = 1 << 20


def _pointed(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that tie the nodes of each component of the edges given to its smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, parent = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(x):
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (higher := parent[parent] != parent).any():
            parent[higher] = parent[parent[higher]]
        x, y = parent[x], parent[y]
        apart = x != y
        x, y = x[apart], y[apart]
    more = parent != np.arange(len(nodes))
    return nodes[more], nodes[parent[more]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as forests, of a fixed number of edges each."""
    empty = np.zeros(0, np.int64)
    a, b, waiting = empty, empty, []
    for batch in batches:
        waiting.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        if sum(len(x) for x, _ in waiting) >= CHUNK:
            a, b = forest(*(np.concatenate(side) for side in zip((a, b), *waiting, strict=True)))
            waiting = []
            if len(a) >= CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = empty, empty
    a, b = forest(*(np.concatenate(side) for side in zip((a, b), *waiting, strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _tied(edges: DataFrame) -> DataFrame:
    """Each task ties up the edges it reads, before they are moved."""
    return shipped(edges).select("a", "b").mapInArrow(_forests, "a bigint, b bigint")


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node is either the centre of one star or a leaf with one edge."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return nodes.filter("up > 1 OR up = 1 AND n > 1").agg(F.count("*")).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest of its neighbours and itself. No more edges than before, some of them repeated."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("a"), F.col("b").alias("m"))  # b is the smaller one for both
    least = ends.groupBy("a").agg(F.min("m").alias("m"))
    upward = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return upward.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = F.explode(F.array("a", "b")).alias("a")
    return edges.join(least, "a").select(moved, F.col("m").alias("b"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b); a component is named after its smallest node.

    Each task first ties the edges it reads into forests, so that few edges and rounds are left. Large
    and small stars alternate until only stars are left, a number of rounds that grows with the
    logarithm of the nodes. Each round is written, so that no lineage grows. The smallest
    neighbour is a pre-aggregated minimum and is joined back, so a node with very many neighbours is
    no group of one task: the join's hot key can be split.
    """
    current = kept(_pointed(_tied(edges)), "edges")
    while not _is_stars(current):
        current = kept(_pointed(_small_star(_large_star(_tied(current)))), "edges")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
