"""Exact top-k by integer inner product: block-at-a-time pruning.

A vector is a document whose terms are its components, with integer weights floor(256 * x). Documents are
kept in blocks of an id range: a forward index (the block's matrix) and each term's largest and smallest
weight. For each query the blocks are put in order of their bound, the sum over the terms of what the
query's weight can reach with the block's extremes, and scored through their forward index until the
bounds fall below the query's k-th best score. An equal bound is still scored: it may hold a smaller id.

Blocks lie in shards, which are met in waves (see ``vectors``): a query brings its k best of earlier waves, so
its bounds are held against them from the first block on. A window with partial limits merges the cells.

Defined cases: vectors null, empty, or with null or non-finite components take no part. Repeated ids are
rows each; a query's own row is every row of its id. Vectors of another dimension than the query's are
not candidates. Weights and scores beyond 64 bits wrap (two's complement); where scores may pass 2**53 no
block is skipped. An empty table has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratus.llm.tables import written
from stratus.llm.vectors import Best, best_of_all, blocks, found_table, matrices, query_blocks, usable

EXACT = 1 << 53  # doubles hold integers up to here


def _wrapped(data: np.ndarray) -> np.ndarray:
    """floor(256 * x) modulo 2**64, as int64, of components of any size."""
    exact = [int(x) * 256 if abs(x) >= EXACT else math.floor(256 * x) for x in data.ravel().tolist()]
    return np.array([x & 0xFFFFFFFFFFFFFFFF for x in exact], dtype=np.uint64).view(np.int64).reshape(data.shape)


def _searcher(k: int):
    def search(key: tuple, queries: pa.Table, documents: pa.Table) -> pa.Table:
        index = []
        for ids, data in matrices(documents):
            weights = np.floor(256 * data)
            index.append((ids, weights, weights.max(axis=0), weights.min(axis=0), data))
        out = []
        for block, known, q_ids, q_data in query_blocks(queries):
            fitting = [b for b in index if b[1].shape[1] == q_data.shape[1]]
            if not fitting:
                continue
            wanted = np.floor(256 * q_data)
            high, low = np.stack([b[2] for b in fitting]), np.stack([b[3] for b in fitting])
            largest = max(float(np.abs(high).max()), float(np.abs(low).max()))
            exact = float(np.abs(wanted).max()) * largest * wanted.shape[1] < EXACT  # doubles hold all sums
            if exact:
                bound = np.maximum(wanted, 0) @ high.T + np.minimum(wanted, 0) @ low.T
            else:
                bound = np.full((len(q_ids), len(fitting)), np.inf)
            order = np.argsort(-bound, axis=1, kind="stable")
            best = Best(q_ids, k, known)
            for step in range(len(fitting)):
                open_blocks: dict[int, list[int]] = {}
                for q in range(len(q_ids)):
                    floor, b = best.floor(q), order[q, step]
                    if floor is None or bound[q, b] >= floor:
                        open_blocks.setdefault(int(b), []).append(q)
                if not open_blocks:
                    break
                for b, qs in open_blocks.items():
                    ids, weights, _, _, data = fitting[b]
                    if exact:
                        scores = (wanted[qs] @ weights.T).astype(np.int64)
                    else:
                        scores = _wrapped(q_data[qs]) @ _wrapped(data).T
                    for row, q in enumerate(qs):
                        floor = best.floor(q)
                        keep = ids != q_ids[q]
                        if floor is not None:
                            keep &= scores[row] >= floor
                        if keep.any():
                            best.offer(q, scores[row][keep], ids[keep])
            out += best.found(block, q_ids)
        return found_table(out, pa.int64())
    return search


def top_k(table: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``table(vec_id, embedding)`` where ``is_query`` holds."""
    vectors = usable(table)
    documents, queries = written(blocks(vectors), "blocks"), written(blocks(vectors.where(is_query)), "queries")
    return best_of_all(queries, documents, _searcher(k), "long", k)
