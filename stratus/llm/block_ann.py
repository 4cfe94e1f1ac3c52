"""Nearest neighbours by cosine: a block matrix join with int8 tiles, error bounds and float recomputation.

Each vector is scaled to length one and quantised to int8 with its own step (largest component / 127).
A tile is the int8 product of a query block and a document block. It gives every cosine up to a
bound that follows from the quantisation: with q = s*a + e and d = t*b + f,
    |q.d - s*t*a.b| <= |e| |d| + |f| |q| + |e| |f|  (lengths of the errors, measured, not assumed).
The k-th largest lower bound of a query so far is a floor; pairs whose upper bound is below it are
dropped, the others are recomputed in double precision from the original vectors and merged into the
query's heap of its k best, which starts with what earlier waves found (see ``vectors``). So no neighbour is lost to quantisation: the search is exact.

Defined cases: vectors null, empty, zero, or with null or non-finite components take no part. Repeated ids
are rows each; a query's own row is every row of its id. Vectors of another dimension are not candidates.
Ties go to the smaller id; equal vectors get equal scores. An empty table has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import written
from stratus.llm.vectors import Best, best_of_all, blocks, found_table, matrices, query_blocks, usable

ROUNDING = 1e-6  # added to every bound: far above the rounding of float sums, far below a tile's error


def quantise(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the vectors scaled to length one, their steps, and the lengths of the errors."""
    big = np.abs(data).max(axis=1, keepdims=True)
    scaled = data / big  # no overflow or underflow in the squares
    unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    step = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / step[:, None]).astype(np.int8)
    error = np.sqrt(((unit - codes * step[:, None]) ** 2).sum(axis=1))
    return codes, step, error


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``query`` in double precision; equal rows get equal values."""
    query, rows = query / np.abs(query).max(), rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows * query).sum(axis=1) / np.sqrt((query * query).sum() * (rows * rows).sum(axis=1))


def _searcher(k: int):
    def search(key: tuple, queries: pa.Table, documents: pa.Table) -> pa.Table:
        index = [(ids, data, *quantise(data)) for ids, data in matrices(documents)]
        out = []
        for block, known, q_ids, q_data in query_blocks(queries):
            q_codes, q_step, q_error = quantise(q_data)
            best = Best(q_ids, k, known)
            for ids, data, codes, step, error in index:
                if data.shape[1] != q_data.shape[1]:
                    continue
                # int8 products sum to less than 2**24 for 1,000 components: single precision is exact
                kind = np.float32 if data.shape[1] <= 1000 else np.float64
                tile = (q_codes.astype(kind) @ codes.astype(kind).T).astype(np.float64) * q_step[:, None] * step
                slack = q_error[:, None] + error + q_error[:, None] * error + ROUNDING
                upper, lower = tile + slack, tile - slack
                own = q_ids[:, None] == ids
                lower[own] = upper[own] = -np.inf
                at = min(k, lower.shape[1]) - 1
                kth = -np.partition(-lower, at, axis=1)[:, at] if lower.shape[1] >= k else np.full(len(q_ids), -np.inf)
                for q in range(len(q_ids)):
                    floor = best.floor(q)
                    floor = kth[q] if floor is None else max(floor - ROUNDING, kth[q])
                    near = np.flatnonzero((upper[q] >= floor) & ~own[q])
                    if len(near):
                        best.offer(q, cosines(q_data[q], data[near]), ids[near])
            out += best.found(block, q_ids)
        return found_table(out, pa.float64())
    return search


def nearest(table: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``table(vec_id, embedding)`` where ``is_query`` holds."""
    vectors = usable(table).where(F.exists("embedding", lambda x: x != 0))
    documents, queries = written(blocks(vectors), "blocks"), written(blocks(vectors.where(is_query)), "queries")
    return best_of_all(queries, documents, _searcher(k), "double", k)
