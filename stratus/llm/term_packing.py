"""Occurrences of terms in Arrow text columns, counted by length-bucketed packing (numpy inside Spark tasks).

A term is a maximal run of ASCII letters and non-ASCII code points, A-Z lower-cased. Its UTF-8 bytes (none of
them zero) are packed big-endian: up to 8 bytes into one uint64 word, up to 16 into two; both buckets are radix-sorted, least
significant 16 bits first, and counted run by run. Longer terms go to buckets by length (up to 32 bytes, 64
and so on), each sorted as fixed-width byte strings; a bucket is at most twice as wide as its terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from stratus.llm.textbytes import ASCII_LETTER, LOWER, chunks

TERM = ASCII_LETTER.copy()
TERM[128:] = True
_HEAD = np.array([0, *(((1 << 64) - 1) ^ ((1 << 8 * (8 - n)) - 1) for n in range(1, 9))], dtype=np.uint64)  # keeps n leading bytes


def radix_order(words: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by the words (most significant first). Sorting 16-bit digits stably is a radix sort in numpy."""
    for word in reversed(words):
        for digit in range(4):
            part = (word >> np.uint64(16 * digit)).astype(np.uint16)
            if len(part) and (part != part[0]).any():
                order = order[np.argsort(part[order], kind="stable")]
    return order


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and documents of the terms."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = TERM[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    edges = offsets[1:-1]
    cut = edges[inside[edges] & inside[edges + 1]]  # two documents that touch
    starts[cut] = ends[cut] = True
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) - at, np.searchsorted(offsets, at, side="right") - 1


def _runs(new: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted occurrences (``new``: the term differs from the one before): first place, occurrences and
    documents of every run of one term and group."""
    new = new | (group != np.concatenate((group[:1], group[:-1])))
    new[0] = True
    first = np.flatnonzero(new)
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    seen = np.concatenate(([0], np.cumsum(fresh)))
    ends = np.append(first[1:], len(new))
    return first, ends - first, seen[ends] - seen[first]


def _counted(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per bucket: start and length of an example, group, occurrences and documents of each term and group."""
    at, length, doc = _spans(data, offsets)
    if not len(at):
        return
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    eight = np.ndarray(shape=(len(data) + 9,), dtype=">u8", buffer=padded, strides=(1,))
    if len(group) < 1 << 16:
        group = group.astype(np.uint16)
    by_group = np.argsort(group[doc], kind="stable")  # terms of a document stay together
    at, length, doc = at[by_group], length[by_group], doc[by_group]

    def out(chosen: np.ndarray, new: np.ndarray):
        own = group[doc[chosen]]
        first, n, docs = _runs(new, own, doc[chosen])
        example = chosen[first]
        return at[example], length[example], own[first], n, docs

    for low, high in ((0, 8), (8, 16)):
        chosen = np.flatnonzero((length > low) & (length <= high))
        if not len(chosen):
            continue
        words = [eight[at[chosen]].astype(np.uint64) & _HEAD[np.minimum(length[chosen], 8)]]
        if high == 16:
            words.append(eight[at[chosen] + 8].astype(np.uint64) & _HEAD[length[chosen] - 8])
        order = radix_order(words, np.arange(len(chosen)))
        new = np.zeros(len(chosen), dtype=bool)
        for w in words:
            new[1:] |= w[order][1:] != w[order][:-1]
        yield out(chosen[order], new)
    width = 32
    while width // 2 < length.max():
        chosen = np.flatnonzero((length > width // 2) & (length <= width))
        if len(chosen):
            text = np.zeros((len(chosen), width), dtype=np.uint8)
            column = np.arange(width)
            where = column < length[chosen][:, None]
            text[where] = data[(at[chosen][:, None] + column)[where]]
            terms = text.view(f"S{width}").reshape(-1)
            order = np.argsort(terms, kind="stable")
            new = np.zeros(len(chosen), dtype=bool)
            new[1:] = terms[order][1:] != terms[order][:-1]
            yield out(chosen[order], new)
        width *= 2


def _strings(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> pa.Array:
    ends = np.cumsum(length)
    places = np.arange(ends[-1]) + np.repeat(at - (ends - length), length)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data[places]))


def count_terms(texts: pa.Array, group: np.ndarray, chunk_bytes: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """For chunks of whole texts: group, term, occurrences and documents; a term and group come once a chunk.
    ``group`` holds a small number for each text."""
    for chunk in chunks(texts, chunk_bytes=chunk_bytes):
        data = LOWER[chunk.data]
        own = group[chunk.first: chunk.first + chunk.docs]
        for at, length, g, n, docs in _counted(data, chunk.offsets, own):
            yield g, _strings(data, at, length), n, docs
