"""Bloom sketches that tell keys met once from keys possibly met again, built in tasks and merged in Spark.

A key sets ``k`` places (distinct ones: double hashing with an odd step over a power of two). A task counts its
places up to two and passes on, for each segment of 65,536 places, those touched once or more and those
touched twice or more. The parts of a segment are added up in one task: a place is *seen twice* where the sum
is two or more. The merged plane of seen-twice places goes to the driver and from there to all tasks. A key
with a place that was not seen twice was met once: that is certain. Any other key is possibly a repeat, to be
settled exactly by the caller.

The plane grows with the number of keys up to ``MOST_PLACES`` (64 MB as bits), which bounds what is sent to
the driver and broadcast. Beyond that it clears fewer keys and more go the exact way; no result changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from stratus.llm.textbytes import mix

SEGMENT = 1 << 16
MOST_PLACES = 1 << 29
HELD = 1 << 20  # places a task holds before it passes them on
_SECOND = np.uint64(0x2545F4914F6CDD1D)

PART = "segment int, once binary, twice binary"


def places_for(keys: int, each: int) -> int:
    """A power of two of at least ``each`` places a key, within the bounds."""
    return min(max(1 << max(keys * each - 1, 0).bit_length(), SEGMENT), MOST_PLACES)


def places(hashes: np.ndarray, n_places: int, k: int) -> np.ndarray:
    """Shape (keys, k); the hashes are uint64."""
    start = mix(hashes)
    step = mix(hashes ^ _SECOND) | np.uint64(1)
    return ((start[:, None] + step[:, None] * np.arange(k, dtype=np.uint64)) & np.uint64(n_places - 1)).astype(np.int64)


def parts(hashes: Iterator[np.ndarray], n_places: int, k: int) -> Iterator[pa.RecordBatch]:
    """A task's part of the sketch (``PART``) from its keys' hashes."""
    def passed_on() -> pa.RecordBatch:
        touched, counts = np.unique(np.concatenate(held), return_counts=True)
        segment, first = np.unique(touched // SEGMENT, return_index=True)
        ends = np.append(first[1:], len(touched))
        low, again = (touched % SEGMENT).astype(np.uint16), counts > 1
        return pa.RecordBatch.from_arrays([
            pa.array(segment.astype(np.int32)),
            pa.array([low[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
            pa.array([low[a:b][again[a:b]].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
        ], ["segment", "once", "twice"])

    held: list[np.ndarray] = []
    n = 0
    for batch in hashes:
        held.append(places(batch, n_places, k).reshape(-1))
        n += len(held[-1])
        if n >= HELD:
            yield passed_on()
            held, n = [], 0
    if n:
        yield passed_on()


def _merge(block: pa.Table) -> pa.Table:
    counts = np.zeros(SEGMENT, dtype=np.uint8)
    for column in ("once", "twice"):
        for part in block[column].to_pylist():
            at = np.frombuffer(part, np.uint16)
            counts[at] = np.minimum(counts[at] + 1, 2)
    return pa.table({"segment": block["segment"].slice(0, 1), "plane": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})


def seen_twice(parted: DataFrame, n_places: int) -> Broadcast:
    """The merged plane of the parts, as bits, on its way to every executor."""
    merged = parted.groupBy("segment").applyInArrow(_merge, "segment int, plane binary").toArrow()
    plane = np.zeros((n_places // SEGMENT, SEGMENT // 8), dtype=np.uint8)
    for segment, bits in zip(merged["segment"].to_pylist(), merged["plane"].to_pylist(), strict=True):
        plane[segment] = np.frombuffer(bits, np.uint8)
    return parted.sparkSession.sparkContext.broadcast(plane.reshape(-1))


def possible(plane: np.ndarray, hashes: np.ndarray, k: int) -> np.ndarray:
    """False where the key was certainly met once."""
    at = places(hashes, 8 * len(plane), k)
    return ((plane[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
