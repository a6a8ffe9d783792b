"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrichor.session import materialize

#: Edges that a task contracts at once.
CONTRACTED = 2_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from nodes to the smallest node that each reaches over the edges given."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right, root = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            hung = root != np.arange(len(nodes))
            return nodes[hung], nodes[root[hung]]
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further


def contracted(edges: DataFrame) -> DataFrame:
    """a, b: fewer edges that connect the same nodes, found part by part where the edges lie."""

    def contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += len(batch)
            if n >= CONTRACTED:
                yield hung(held)
                held, n = [], 0
        if held:
            yield hung(held)

    def hung(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = forest(*(np.concatenate(side) for side in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return edges.where("a != b").select("a", "b").mapInArrow(contract, "a long, b long")


def _nodes(stars: DataFrame) -> DataFrame:
    """node, root: the nodes that hang below a root, and the roots themselves."""
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node reaches; nodes without edges are not listed.

    ``edges`` has two long columns, a and b. Rounds alternate between hanging a node's larger
    neighbours, and then its smaller ones, below its smallest neighbour. Minima are aggregated
    before they are shuffled, and a node with very many edges is one side of an ordinary join.
    Before each round every task contracts the edges it holds, a bounded number at a time, which
    saves most of the rounds that long chains would take, and edges that one task may contract at
    once are finished there.
    """
    stars, known = materialize(contracted(edges).distinct(), "edges"), None
    while True:
        if stars.count() <= CONTRACTED:
            return _nodes(materialize(contracted(stars.coalesce(1)), "forest"))
        state = stars.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if known == state:
            return _nodes(stars)
        known = state
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        stars = small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
        stars = materialize(contracted(stars).distinct(), "edges")
