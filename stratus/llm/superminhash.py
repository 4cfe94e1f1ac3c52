"""SuperMinHash signatures (numpy, many documents at once).

Each element of a set draws, level by level, a place of a random permutation of the signature's
positions and a uniform number; at level j it offers the value ``j + uniform`` to the position the
permutation holds at j, and each position keeps its minimum. The permutations make the positions'
minima correlated, which lowers the variance of the similarity estimate for small sets. Levels rise, so
once every position of a document has a value no later level can lower one: the document stops early.
A set much larger than the signature needs one or two levels.
"""

from __future__ import annotations

import numpy as np

from stratus.llm.textbytes import mix

_LEVEL = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(hashes: np.ndarray, sizes: np.ndarray, positions: int) -> np.ndarray:
    """``hashes`` holds the sets' distinct 64-bit element hashes one after another, ``sizes`` their lengths.
    Returns an array (sets, positions) of 64-bit values: level in the high, uniform in the low 32 bits;
    an empty set keeps ``EMPTY`` everywhere."""
    m, n = np.uint64(positions), len(sizes)
    out = np.full((n, positions), EMPTY, dtype=np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
    element, order = hashes, None
    for level in range(positions):
        if not len(element):
            break
        draw = mix(element + np.uint64((level + 1) * _LEVEL & _MASK))
        uniform = draw & np.uint64(0xFFFFFFFF)
        swap = level + (((draw >> np.uint64(32)) * (m - np.uint64(level))) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(element))
        if level == 0:
            place = swap
        else:
            place = order[rows, swap].astype(np.int64)
            order[rows, swap] = order[:, level]
        np.minimum.at(flat, owner * positions + place, (np.uint64(level) << np.uint64(32)) | uniform)
        unfilled = (out == EMPTY).any(axis=1)
        going = unfilled[owner]
        if not going.any():
            break
        if level == 0:  # the swap of level 0 on an identity permutation
            owner, element, place = owner[going], element[going], place[going]
            order = np.tile(np.arange(positions, dtype=np.int16), (len(element), 1))
            order[np.arange(len(element)), place] = 0
        elif not going.all():
            owner, element, order = owner[going], element[going], order[going]
    return out


def bands(signature: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of ``rows`` positions, different between bands; shape (sets, n_bands)."""
    out = np.empty((len(signature), n_bands), dtype=np.uint64)
    for b in range(n_bands):
        h = np.full(len(signature), mix(np.array([b + 1], dtype=np.uint64))[0])
        for r in range(rows):
            h = mix(h ^ signature[:, b * rows + r])
        out[:, b] = h
    return out
