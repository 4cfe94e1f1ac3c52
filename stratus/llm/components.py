"""Connected components of an undirected edge table: union-find inside partitions, then star contraction.

Edges are long pairs ``(a, b)``. Each task first runs union-find over its own edges and passes on only a
spanning forest. A forest of ``FEW_EDGES`` edges or fewer is finished by union-find in one task. A larger one
goes through large-star and small-star rounds (every node hands its neighbours to the smallest
one), grouped joins that run until nothing changes. No group is gathered: the minima are aggregated with
partial sums before the shuffle, and a node with very many edges is a skewed join side, which AQE splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import written


class UnionFind:
    """Smallest member as root, path halving."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


MOST_NODES = 1_000_000  # of one task's forest; it is passed on and begun anew beyond
FEW_EDGES = 400_000  # they have fewer nodes than MOST_NODES


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(f: UnionFind) -> pa.RecordBatch:
        nodes = [x for x in f.parent if f.find(x) != x]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([f.find(x) for x in nodes], pa.int64())], ["a", "b"])

    forest = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.union(a, b)
        if len(forest.parent) > MOST_NODES:
            yield out(forest)
            forest = UnionFind()
    yield out(forest)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest reachable node) for every node of an edge; raises if not done in ``rounds``."""
    links = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                    .where("a <> b").mapInArrow(_forest, "a long, b long").distinct(), "forest")
    if links.count() <= FEW_EDGES:
        roots = links.coalesce(1).mapInArrow(_forest, "a long, b long")
        return written(roots.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("component")),
                                                      F.struct(F.col("b").alias("node"), F.col("b").alias("component")))).alias("x"))
                       .select("x.*"), "roots").distinct()
    before = None
    for _ in range(rounds):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        # now every edge points down: a > b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct("a", F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").where("a <> b").distinct()
        links = written(small, "stars")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")) \
                .union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = now
    raise RuntimeError(f"components did not converge in {rounds} rounds")
