"""Token ids of whole texts by a public tokenizer file, with a per-worker table of known words.

Texts are cut into words at ASCII white space and between an ASCII letter and ASCII punctuation. The
tokenizer drops white space and never merges across either cut, so a text's ids are its words' ids in a
row. Each word is looked up by the hash of its bytes (ASCII letters lowered, as the tokenizer lowers
them); only words not met before go to the tokenizer. Texts that may hold one of the tokenizer's special
strings are given to it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stratus.llm.textbytes import chunks

MOST_WORDS = 1_000_000  # known words of a worker; the table is begun anew beyond
WHOLE = r"<\|"  # begins each special string of the tokenizer files


class WordIds:
    """Sorted word hashes, and for each the place and number of its ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.at, self.count = np.empty(0, np.int64), np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.array([len(x) for x in found], dtype=np.int32)
        flat = np.array([i for x in found for i in x], dtype=np.uint32)
        at = len(self.ids) + np.cumsum(count, dtype=np.int64) - count
        self.ids = np.concatenate((self.ids, flat))
        where = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, where, hashes)
        self.at, self.count = np.insert(self.at, where, at), np.insert(self.count, where, count)

    def of(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each chunk: its first row, the ids of its documents one after another, their numbers of ids."""
        odd = pc.match_substring_regex(column.cast(pa.large_string()).fill_null(""), WHOLE)
        for chunk in chunks(column, lower=True):
            if len(self.hashes) > MOST_WORDS:
                self.clear()
            starts, ends, first = chunk.words(split_punct=True)
            unique, example, inverse = np.unique(chunk.spans(starts, ends), return_index=True, return_inverse=True)
            at = np.searchsorted(self.hashes, unique)
            known = at < len(self.hashes)
            known[known] = self.hashes[at[known]] == unique[known]
            if not known.all():
                data = chunk.data.tobytes()
                new = example[~known]
                self.learn(unique[~known], [data[a:b].decode("utf-8") for a, b in zip(starts[new], ends[new], strict=True)])
                at = np.searchsorted(self.hashes, unique)
            word = at[inverse]
            count = self.count[word]
            total = np.concatenate(([0], np.cumsum(count)))
            ids = self.ids[np.arange(total[-1]) + np.repeat(self.at[word] - total[:-1], count)]
            sizes = total[first[1:]] - total[first[:-1]]
            special = np.flatnonzero(odd.slice(chunk.first, chunk.docs).to_numpy(zero_copy_only=False))
            if len(special):
                parts = np.split(ids, np.cumsum(sizes)[:-1])
                for d in special:
                    parts[d] = self.whole(column[chunk.first + int(d)].as_py())
                ids, sizes = np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)
            yield chunk.first, ids, sizes


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's table for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
