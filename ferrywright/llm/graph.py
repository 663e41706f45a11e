"""Distributed union-find over an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Nodes that a task holds when it takes its own edges together.
HELD_NODES = 1_000_000


def _local_forests(edges: DataFrame) -> DataFrame:
    """Edges of the same components, fewer and shorter paths: each task's own edges as stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union = UnionFind()

        def stars() -> pa.RecordBatch:
            pairs = union.edges()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                union.union(a, b)
            if len(union.parent) > HELD_NODES:
                yield stars()
                union = UnionFind()
        yield stars()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("h")).first()
    return row.n, row.h or 0


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star steps.

    ``edges`` has two long columns ``a`` and ``b``; rows with a
    null, loops and repeats do no harm. Returns ``(node, root)`` for every node of
    a true edge, root being the smallest node of its component. A step joins each
    edge with the smallest neighbour of its end, an aggregate, so that no
    neighbourhood is gathered; each round is written as a scratch table, and
    rounds go with the logarithm of the component's size.
    """
    spark = edges.sparkSession
    plain = edges.where("a is not null and b is not null and a <> b")
    current = common.stage(_local_forests(plain.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))).distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        mins = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(mins, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(mins.select("a", F.col("m").alias("b"))).distinct()
        following = common.stage(small, "edges")
        common.release(spark, [current.staged_at])
        current, before = following, state
        state = _state(current)
        if state == before and _is_star(current):
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _is_star(edges: DataFrame) -> bool:
    """Whether no root is a node below another one, and each node has one root."""
    chained = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count()
    return not chained and not edges.groupBy("a").count().where("count > 1").limit(1).count()


class UnionFind:
    """Union-find inside one task; the smaller item becomes the root."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root and x != root:
            parent[x] = root
            x = up
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            self.parent[high] = low

    def edges(self):
        """(item, root) of every item that has another root."""
        return [(x, self.find(x)) for x in self.parent]
