"""Vector blocks: rows of an embedding table packed into matrices, and the grid that lets query blocks meet them.

A block is one row with its ids and its vectors as bytes, so shuffles move few, large rows. Query blocks
meet document blocks in a grid: document blocks are dealt to shards, query blocks to groups, and a task
holds one shard and one group. Every query meets every row once; nothing is broadcast or collected.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.tables import written

BLOCK_ROWS = 512
SHARD_BLOCKS = 16  # document blocks of a task: at most 8192 rows at a time
GROWTH = 8  # after each wave so many times the shards have been met
BLOCK = "first_id long, rows int, dim int, ids binary, data binary"


def usable(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id long, embedding array<double>`` of the rows whose vector is neither null nor empty and holds
    no null or non-finite component."""
    t = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return t.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition into blocks, by dimension, in the order they come (sorted: ranges of ids)."""
    held: dict[int, list] = {}

    def out(dim: int) -> pa.RecordBatch:
        ids = np.concatenate([x[0] for x in held[dim]])
        data = np.concatenate([x[1] for x in held[dim]])
        held[dim] = []
        return pa.RecordBatch.from_pydict({
            "first_id": pa.array([int(ids.min())], pa.int64()), "rows": pa.array([len(ids)], pa.int32()),
            "dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
            "data": pa.array([data.tobytes()], pa.binary())})

    for batch in batches:
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        offsets = vectors.offsets.to_numpy()
        flat = vectors.values.to_numpy()
        dims = np.diff(offsets)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            data = flat[offsets[at][:, None] + np.arange(dim)]
            for k in range(0, len(at), BLOCK_ROWS):
                held.setdefault(dim, []).append((ids[at[k: k + BLOCK_ROWS]], data[k: k + BLOCK_ROWS]))
                if sum(len(x[0]) for x in held[dim]) >= BLOCK_ROWS:
                    yield out(dim)
    for dim in list(held):
        if held[dim]:
            yield out(dim)


def blocks(vectors: DataFrame) -> DataFrame:
    """``vectors`` (see ``usable``), sorted by id inside each partition, packed into block rows."""
    return vectors.sortWithinPartitions("vec_id").mapInArrow(_pack, BLOCK)


def matrices(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and float64 matrix of each block row."""
    return [(np.frombuffer(i, np.int64), np.frombuffer(d, np.float64).reshape(-1, dim))
            for i, d, dim in zip(table["ids"].to_pylist(), table["data"].to_pylist(), table["dim"].to_pylist(), strict=True)]


def waves(shards: int) -> list[tuple[int, int]]:
    """Ranges of shards: the first alone, then each so long that ``GROWTH`` times as many have been met."""
    out, first, last = [], 0, 1
    while first < shards:
        out.append((first, min(last, shards)))
        first, last = last, last * GROWTH
    return out


class Best:
    """The ``k`` best candidates of each query, as heaps with the worst on top: higher score first, ties to the
    smaller id. Candidates ``known`` from other cells only raise the floor; ``found`` has the others."""

    def __init__(self, query_ids: np.ndarray, k: int, known: list[dict] | None) -> None:
        held: dict[int, list] = {}
        for row in known or ():
            held.setdefault(row["query_id"], []).append((row["score"], ~row["vec_id"], False))
        self.k = k
        self.heaps = [list(held.get(q, ())) for q in query_ids.tolist()]
        for heap in self.heaps:
            heapq.heapify(heap)

    def floor(self, q: int):
        return self.heaps[q][0][0] if len(self.heaps[q]) == self.k else None

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:  # of very many, the k best
            near = np.flatnonzero(scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k])
            near = near[np.lexsort((~ids[near], scores[near]))[-self.k:]]
            scores, ids = scores[near], ids[near]
        heap = self.heaps[q]
        for score, place in zip(scores.tolist(), (~ids).tolist(), strict=True):
            if len(heap) < self.k:
                heapq.heappush(heap, (score, place, True))
            elif (score, place, True) > heap[0]:
                heapq.heapreplace(heap, (score, place, True))

    def found(self, block: int, query_ids: np.ndarray) -> Iterator[tuple]:
        """``block, query_id, vec_id, score`` of what this cell adds."""
        for q, heap in zip(query_ids.tolist(), self.heaps, strict=True):
            for score, place, fresh in heap:
                if fresh:
                    yield block, q, ~place, score


def query_blocks(table: pa.Table) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """Key, candidates known so far, ids and matrix of each query block."""
    for block, known, (ids, data) in zip(table["block"].to_pylist(), table["known"].to_pylist(), matrices(table), strict=True):
        yield block, known, ids, data


def found_table(rows: list[tuple], score: pa.DataType) -> pa.Table:
    block, query, vec, scores = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"block": pa.array(block, pa.int64()), "query_id": pa.array(query, pa.int64()),
                     "vec_id": pa.array(vec, pa.int64()), "score": pa.array(scores, score)})


def _ranked(candidates: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_of_all(queries: DataFrame, documents: DataFrame, search, score: str, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of each query, by ``search(key, queries, documents)`` on every
    cell of the grid of query groups and document shards. Blocks are dealt by a hash of their place, so a cell's
    size does not depend on the data's order.

    Shards are met in waves, each ``GROWTH`` times as long as all before it. A wave's query blocks carry the k best
    found so far, and its cells return only what beats them: about k * GROWTH rows a query and wave, with
    log(shards) waves, where cells on their own would return k rows for every shard."""
    groups = max(1, -(-queries.count() // SHARD_BLOCKS))
    shards = max(1, -(-documents.count() // SHARD_BLOCKS))
    schema = f"block long, query_id long, vec_id long, score {score}"
    place = F.pmod(F.xxhash64("first_id", "rows", "ids"), F.lit(1 << 20))
    q = queries.withColumn("grp", F.floor(place * groups / (1 << 20)).cast("int")).withColumn("block", F.xxhash64("ids", "data"))
    d = documents.withColumn("shard", F.floor(place * shards / (1 << 20)).cast("int"))
    item, best = "struct<query_id: bigint, vec_id: bigint, score: " + score + ">", None
    for first, last in waves(shards):
        if best is None:
            held = q.withColumn("known", F.lit(None).cast(f"array<{item}>"))
        else:  # at most k rows for each of a block's queries
            known = best.groupBy("block").agg(F.collect_list(F.struct("query_id", "vec_id", "score")).alias("known"))
            held = q.join(known, "block", "left")
        cells = held.withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(last - 1)))).groupBy("grp", "shard").cogroup(
            d.where(F.col("shard").between(first, last - 1))
            .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).groupBy("grp", "shard")).applyInArrow(search, schema)
        found = cells if best is None else best.unionByName(cells)
        if last < shards:
            best = written(_ranked(found, k, "block", "query_id").drop("rank"), "wave")
    return _ranked(found, k, "query_id").select("query_id", "rank", "vec_id", "score")
