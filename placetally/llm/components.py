"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placetally.llm.common import stored

EDGES_PER_TASK = 1_000_000
ROUNDS = 60


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, smallest node of its component) of the given edges."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        if np.array_equal(before, label):
            break
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b, held = [], [], 0
    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
        held += batch.num_rows
        if held > 2 * EDGES_PER_TASK:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0 if len(x) < EDGES_PER_TASK else held
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
                a, b, held = [], [], 0
    if a:
        x, y = forest(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (two long columns): the smallest node reachable.

    Edges are contracted to stars within each partition, then hung from the
    smallest neighbour in turns (large star, small star) until nothing changes.
    Minima are combined before each shuffle, and the join of edges with minima
    is an ordinary one whose large partitions Spark splits, so a node with very
    many neighbours is not one task's work.  Null ends and loops are no edges;
    no edges give no rows.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = edges.filter("a is not null and b is not null and a <> b")
    edges = stored(edges.mapInArrow(_contracted, "a long, b long").distinct(), "edges")
    state = None
    for _ in range(ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "edges")
        seen = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components have not settled after {ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung from the node's smallest neighbour (or the node itself)."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    larger = both.filter("b > a").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung from the smallest of them.  Edges point to the smaller end."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    others = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "u").filter("v <> m")
    return others.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m")).distinct()
