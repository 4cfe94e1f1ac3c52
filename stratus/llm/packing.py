"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

Every task tokenizes its documents and packs them in groups of a few thousand pieces, so nothing is
shuffled and a group's memory is bounded. In a group a document's full windows are split off; what is
left is cut into pieces of at most a quarter window, and pieces smaller than a sixteenth are bundled to that size, so that many
short texts fill windows as long ones do. Differencing starts with each piece as a partial
partition into k windows (the piece, and k - 1 empty ones) and always merges the two partial partitions
with the largest imbalance, the largest windows of one with the smallest of the other, until one
partition is left: k near-equal windows. k begins at the least number that can hold the tokens and rises
while a window exceeds the capacity.

Defined cases: null or empty text: only the end id. Repeated rows are packed each. A null doc_id stays
null. An empty table gives no rows. Other columns are ignored. Window numbers are unique, not gapless: they
hold the task, the group and the window in it.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.tokens import word_ids

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, n_chars long")
GROUP_TOKENS = 1 << 20  # a group is packed when it holds as many ids
GROUP_DOCS = 1 << 18  # or as many documents: 64 windows even of texts that are one id


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: the items of each of ``k`` windows."""
    if k == 1:
        return [list(range(len(sizes)))]
    state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap = []
    # a partial partition: its windows' sums, rising, and for each the node of its items
    for i, size in enumerate(sizes):
        sums, items = np.zeros(k, dtype=np.int64), np.full(k, -1, dtype=np.int64)
        sums[-1], items[-1] = size, i
        state[i] = sums, items
        heap.append((-size, i))
    heapq.heapify(heap)
    joined: list[tuple[int, int]] = []  # node len(sizes) + j holds the items of two nodes
    number = len(sizes)
    while len(heap) > 1:
        (_, x), (_, y) = heapq.heappop(heap), heapq.heappop(heap)
        (a, p), (b, q) = state.pop(x), state.pop(y)
        b, q = b[::-1], q[::-1]
        sums, items = a + b, np.where(p < 0, q, p)
        for w in np.flatnonzero((p >= 0) & (q >= 0)):
            items[w] = len(sizes) + len(joined)
            joined.append((int(p[w]), int(q[w])))
        order = np.argsort(sums, kind="stable")
        sums, items = sums[order], items[order]
        state[number] = sums - sums[0], items
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), number))
        number += 1
    _, items = state[heap[0][1]]
    windows = []
    for node in items.tolist():
        found, todo = [], [node] if node >= 0 else []
        while todo:
            n = todo.pop()
            if n < len(sizes):
                found.append(n)
            else:
                todo.extend(joined[n - len(sizes)])
        windows.append(sorted(found))
    return windows


def bundled(sizes: list[int], small: int) -> list[list[int]]:
    """The items, those under ``small`` joined in order until they reach it."""
    out, held, total = [], [], 0
    for i, size in enumerate(sizes):
        if size >= small:
            out.append([i])
            continue
        held.append(i)
        total += size
        if total >= small:
            out.append(held)
            held, total = [], 0
    return out + [held] if held else out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows within ``capacity``; their number rises until each fits."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = difference(sizes, k)
        if max(sum(sizes[i] for i in w) for w in windows) <= capacity:
            return windows
        k += 1


def _packer(path: str, capacity: int, end_id: int):
    quarter, small = max(1, capacity // 4), max(1, capacity // 16)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        base = TaskContext.get().partitionId() << 40
        used, group, held = 0, [], 0

        def packed() -> pa.RecordBatch:
            nonlocal used
            items, out = [], []
            for doc_id, ids, chars in group:
                n, at = len(ids), 0
                while n - at >= capacity:
                    out.append((doc_id, ids, at, capacity, used, 0, chars))
                    used += 1
                    at += capacity
                parts = -(-(n - at) // quarter)
                for p in range(parts):
                    size = (n - at) // (parts - p)
                    items.append((doc_id, ids, at, size, chars))
                    at += size
            if items:
                bundles = bundled([x[3] for x in items], small)
                for window in windows_of([sum(items[i][3] for i in b) for b in bundles], capacity):
                    offset = 0
                    for i in (i for b in window for i in bundles[b]):
                        doc_id, ids, at, size, chars = items[i]
                        out.append((doc_id, ids, at, size, used, offset, chars))
                        offset += size
                    used += 1
            crc = [zlib.crc32(ids[at: at + n].astype("<u4").tobytes()) for _, ids, at, n, _, _, _ in out]
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array([x[0] for x in out], pa.int64()), "start": pa.array([x[2] for x in out], pa.int64()),
                "length": pa.array([x[3] for x in out], pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array([len(x[1]) for x in out], pa.int64()),
                "sequence_id": pa.array([base + x[4] for x in out], pa.int64()),
                "offset": pa.array([x[5] for x in out], pa.int64()), "n_chars": pa.array([x[6] for x in out], pa.int64())})

        for batch in batches:
            chars = batch.column(2).to_pylist()
            doc_ids = batch.column(0).to_pylist()
            for first, ids, sizes in known.of(batch.column(1)):
                ends = np.cumsum(sizes)
                for d, (e, n) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
                    group.append((doc_ids[first + d], np.append(ids[e - n: e], np.uint32(end_id)), chars[first + d]))
                    held += n + 1
                    if held >= GROUP_TOKENS or len(group) >= GROUP_DOCS:
                        yield packed()
                        group, held = [], 0
        if group:
            yield packed()
    return pack


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and the document's ``n_chars``. ``tokenizer`` is the path of a tokenizer file on every worker."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"))
    return docs.mapInArrow(_packer(tokenizer, capacity, end_id), PIECES)
