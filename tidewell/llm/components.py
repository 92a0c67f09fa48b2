"""Connected components of a graph given as an edge table, by alternating large-star and small-star rounds.

Every round is two joins and two aggregations over the remaining edges; a node's smallest neighbour comes from a partial
aggregate, and the joins that hand it out move both sides, so that Spark may split them for nodes with many edges. Each round is
checkpointed. It ends when a round changes nothing: then every node points at the smallest node of its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut_lineage


def dealt_anew(column: str) -> Column:
    """A column's own value, in a form that hides how its rows are partitioned.

    An aggregate's result is partitioned by its key already, so joining it would move the other side only, and Spark splits
    a join's hot keys only if it moves both sides.
    """
    return F.bitwise_not(F.bitwise_not(F.col(column))).alias(column)


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(dealt_anew("a"), F.least("a", "m").alias("m"))
    return both.join(least, "a").filter((F.col("b") > F.col("a")) & (F.col("b") != F.col("m"))).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least.select(dealt_anew("a"), "m"), "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) that isn't the smallest of its component. No edges: no rows."""
    edges = cut_lineage(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    while before[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


class Forest:
    """Union-find over the numbers 0 to n-1, for pairs that come in arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        p = self.parent
        r = p[x]
        while True:
            up = p[r]
            if np.array_equal(up, r):
                break
            r = up
        p[x] = r
        return r

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            if len(a):
                np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(node, root) for every node that isn't a root."""
        every = np.arange(len(self.parent))
        roots = self.roots(every)
        moved = roots != every
        return every[moved], roots[moved]


def shrink(edges: DataFrame) -> DataFrame:
    """Edges of a spanning forest of each batch of ``edges`` (a, b: long): the same components from fewer rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, at = np.unique(np.concatenate([b.column(0).to_numpy(), b.column(1).to_numpy()]), return_inverse=True)
            f = Forest(len(nodes))
            f.union(at[: b.num_rows], at[b.num_rows :])
            x, r = f.edges()
            yield pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[r])], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")
