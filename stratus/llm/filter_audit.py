"""How document filters interact: what each removes in every order, from additive counts of failure masks.

1. Counting-Bloom prepass (``seen``): tasks count the hashes of whole texts into sketches, the merged sketch
   clears the texts that are certainly unique.
2. One pass over the texts gives each document the mask of filters it fails (A to D) and passes on the text
   of possible repeats only. These shuffle: the smallest id of each whole text is found exactly, and a document
   with a larger id fails E.
3. Masks are joined with the labels and counted per part and mask. Counts are additive, so the effect of each
   filter at each place of each of the 120 orders follows from at most 32 counts a part by matrix products.

Filters: A under 200 words, B under half of the words distinct, C more than 2 % capitals, D holds any of
``#$%&*|``, E the whole text of a smaller doc_id. Words are maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive.

Defined cases: null text is empty; it has no words, so it fails A, never B or C. A null source counts as the
empty one. A null doc_id is counted, never fails E and makes no other row fail it. Rows of one doc_id with
one text do not repeat each other; each row is counted. Several label rows of a doc_id are one that has a
mark where any has it; a null mark is none. Very long texts are taken whole, one in memory at a time beside
its Arrow batch. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import seen
from stratus.llm.tables import written

LETTERS = "ABCDE"
REPEAT = 1 << LETTERS.index("E")
PLACES_EACH, K = 16, 6  # a unique text passes as possible repeat with chance (1 - e^(-6/16))^6 = 0.0009
CAPITALS = bytes(range(65, 91))
MARKS = re.compile(rb"[#$%&*|]")


def failed(data: bytes, code_points: int) -> int:
    """Mask of the filters A to D that a text fails; ``bytes.split`` cuts at exactly the six white bytes."""
    words = data.split()
    n, distinct = len(words), len(set(words))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (n < 200) | (100 * distinct < 50 * n) << 1 | (100 * capitals > 2 * code_points) << 2 | (MARKS.search(data) is not None) << 3


def _sketcher(n_places: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return seen.parts((b.column(0).to_numpy().view(np.uint64) for b in batches), n_places, K)
    return sketch


def _flagger(plane: Broadcast):
    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, part, text, h = (batch.column(i) for i in range(4))
            lengths = pc.utf8_length(text).to_pylist()
            masks = [failed(x.as_buffer().to_pybytes(), n) for x, n in zip(text, lengths, strict=True)]
            maybe = seen.possible(plane.value, h.to_numpy().view(np.uint64), K)
            yield pa.RecordBatch.from_arrays(
                [doc_id, part, pa.array(masks, pa.int32()), h, pc.if_else(pa.array(maybe), text, pa.scalar(None, text.type))],
                ["doc_id", "part", "mask", "h", "text"])
    return flag


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask`` for every row of ``docs(doc_id, text, source)``: bit i is set where it fails filter i."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.xxhash64(text).alias("h"))
    n_places = seen.places_for(docs.count(), PLACES_EACH)
    plane = seen.seen_twice(docs.select("h").mapInArrow(_sketcher(n_places), seen.PART), n_places)
    flagged = written(docs.mapInArrow(_flagger(plane), "doc_id long, part string, mask int, h long, text string"), "flagged")
    again = flagged.where("text IS NOT NULL")
    first = written(again.groupBy("h", "text").agg(F.min("doc_id").alias("first")), "first")
    repeat = F.when(F.col("doc_id") > F.col("first"), F.lit(REPEAT)).otherwise(F.lit(0))
    settled = again.join(first, ["h", "text"]).select("doc_id", "part", (F.col("mask") + repeat).alias("mask"))
    return flagged.where("text IS NULL").select("doc_id", "part", "mask").union(settled)


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled so."""
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    return flags.join(marked, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("is_good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("is_toxic"), F.lit(0)).alias("toxic"))


def _effects() -> tuple[list[tuple[str, int, int]], dict[str, np.ndarray]]:
    """(order, step, letter) of all 600 steps, and which masks each step keeps, removes, and so on (600 x 32)."""
    steps, rows = [], {name: [] for name in ("kept", "removed", "redundant", "unique_fails")}
    mask = np.arange(1 << len(LETTERS))
    for order in itertools.permutations(range(len(LETTERS))):
        gone = np.zeros(len(mask), dtype=bool)
        for at, letter in enumerate(order):
            fails = (mask >> letter & 1).astype(bool)
            steps.append(("".join(LETTERS[x] for x in order), at + 1, letter))
            rows["removed"].append(fails & ~gone)
            rows["redundant"].append(fails & gone)
            rows["unique_fails"].append(mask == 1 << letter)
            gone = gone | fails
            rows["kept"].append(~gone)
    return steps, {name: np.array(x, dtype=np.int64) for name, x in rows.items()}


STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps, effect = _effects()
    letter = np.array([x for _, _, x in steps])
    order, step = pa.array([x for x, _, _ in steps]), pa.array([x for _, x, _ in steps], pa.int32())
    for batch in batches:
        for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n, good, toxic = (np.zeros(1 << len(LETTERS), dtype=np.int64) for _ in range(3))
            for c in cells:
                n[c["mask"]], good[c["mask"]], toxic[c["mask"]] = c["n"], c["good"], c["toxic"]
            found = {name: rows @ n for name, rows in effect.items()}
            found |= {"good_lost": effect["removed"] @ good, "toxic_lost": effect["removed"] @ toxic}
            found["shapley"] = np.array([found["removed"][letter == x].sum() for x in range(len(LETTERS))])[letter]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(steps)), order, step, *map(pa.array, found.values())],
                                             ["part", "filter_order", "step", *found])


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts of masks; a part's list has 32 entries at most."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(_orders, STEPS)
