"""Lines that stand in many documents are dropped from all but one of them.

1. Two Bloom filters (``seen``): each task marks the places of its documents' line keys as seen once and seen
   twice; the merged seen-twice filter clears keys that stand in one document for certain.
2. Only suspected keys shuffle, one row a key and document. Whole keys are counted exactly; those in
   ``documents`` documents or more keep their lines in the largest doc_id that holds them.
3. A document without a suspected key is done where it is read. The others meet the list of the keys they lose
   (a list is bounded by its document's lines), and the kept lines are joined again.

A key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased; keys under ``chars`` code
points are never dropped.

Defined cases: null or empty text is one empty line. A null doc_id keeps all its lines and counts for no key.
Rows of one doc_id are one document: each of them loses the same keys. Within the document that keeps a key all
its lines stay. Very long texts and lines are taken whole. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import seen
from stratus.llm.tables import written

PLACES_EACH, K = 8, 4  # of the most keys that the bytes of the texts could hold: at worst 2.4 % false suspects
WHITE = b" \t\n\r\x0b\x0c"


def key_of(line: bytes) -> bytes:
    return line.strip(WHITE).lower()  # of bytes: A-Z only


def long_keys(data: bytes, chars: int) -> set[bytes]:
    keys = {key_of(line) for line in data.split(b"\n") if len(line) >= chars}
    return {k for k in keys if len(k) >= chars and (k.isascii() or len(k.decode()) >= chars)}


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(k, digest_size=8).digest() for k in keys), np.uint64)


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def _sketcher(n_places: int, chars: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_hashes([k for data in _texts(b.column(1)) for k in long_keys(data, chars)]) for b in batches)
        return seen.parts(found, n_places, K)
    return sketch


def _suspects(batch: pa.RecordBatch, plane: np.ndarray, chars: int) -> list[list[bytes]]:
    """Of each row the keys that may stand in another document."""
    keys = [[*long_keys(data, chars)] if i is not None else []
            for i, data in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True)]
    maybe = seen.possible(plane, _hashes([k for own in keys for k in own]), K)
    ends = np.cumsum([len(own) for own in keys])
    return [[k for k, m in zip(own, maybe[e - len(own): e], strict=True) if m] for own, e in zip(keys, ends, strict=True)]


def _lister(plane: Broadcast, chars: int):
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _suspects(batch, plane.value, chars)
            ids = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(ids)), pa.array([k for x in found for k in x], pa.binary()).cast(pa.string())], ["doc_id", "key"])
    return suspects


def _chooser(plane: Broadcast, chars: int, suspected: bool):
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = [bool(x) == suspected for x in _suspects(batch, plane.value, chars)]
            yield batch.filter(pa.array(mask, pa.bool_()))
    return choose


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        for data, keys in zip(_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            lines, drop = data.split(b"\n"), {k.encode() for k in keys or ()}
            stay = [x for x in lines if key_of(x) not in drop] if drop else lines
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                                          pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])


def dedup_lines(docs: DataFrame, documents: int = 5, chars: int = 40) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` (what is left) for every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_places = seen.places_for(size // chars, PLACES_EACH)
    plane = seen.seen_twice(docs.where("doc_id IS NOT NULL").mapInArrow(_sketcher(n_places, chars), seen.PART), n_places)
    suspects = written(docs.mapInArrow(_lister(plane, chars), "doc_id long, key string"), "suspects").distinct()
    common = written(suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
                     .where(F.col("n") >= documents).select("key", "keeper"), "common")
    losses = written(suspects.join(common, "key").where("doc_id <> keeper").select("doc_id", "key"), "losses")
    lists = losses.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    clear = docs.mapInArrow(_chooser(plane, chars, False), docs.schema).withColumn("keys", F.lit(None).cast("array<string>"))
    held = docs.mapInArrow(_chooser(plane, chars, True), docs.schema).join(lists, "doc_id", "left").select("doc_id", "text", "keys")
    return clear.union(held).mapInArrow(_drop, "doc_id long, n_lines long, n_dropped long, text string")
