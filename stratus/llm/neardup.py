"""Near-duplicate documents: SuperMinHash, banding, verification on full sets, union-find grouping.

1. One pass over the texts gives every document its set of word shingles as 64-bit hashes, the set's
   size, a 128-bit digest of the set and the band hashes of its SuperMinHash signature.
2. Documents with equal sets form a class; its smallest id stands for it from here on, so copies are
   never paired. A document without words is linked with nothing.
3. Representatives that share a band meet in a bucket. A bucket is not expanded into its pairs. Its most
   popular member (most meetings over all bands: the likely original) is paired with each other member,
   and these pairs are verified on the full sets and grouped. Where a bucket's members are then still in
   different components, its members outside the bucket's largest component are compared with all
   members of other components, block against block inside tasks: blocks are bounded in bytes and rows, the
   signatures rule out pairs five standard errors below the threshold, the rest are decided on the full
   sets, a pair in the first band it shares only, and a task passes on a spanning forest of the links.
   So every two members of a bucket are compared or known to be connected; none is dropped.
4. Union-find grouping over the verified links, joined back to all documents.

Defaults: 25 bands of 5 rows find a pair at similarity 0.85 but for a chance of 4e-7, at 0.8 of 5e-5.

Defined cases: null or blank text: an empty set, its own component, kept. Fewer words than a shingle: the
whole sequence as one element. Repeated doc_ids are one node, whose rows all get its component and each
their own ``n_shingles``. A null doc_id takes no part: null component, kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.components import UnionFind, components
from stratus.llm.superminhash import bands as band_hashes
from stratus.llm.superminhash import signatures
from stratus.llm.tables import written
from stratus.llm.textbytes import chunks, mix

_SHORT = 0xA0761D6478BD642F
_STEP = np.uint64(0xE7037ED1A0B428DB)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each chunk of the column: its first row, the documents' set sizes, and the distinct shingle hashes
    of each document, sorted, one document after another."""
    for chunk in chunks(column, lower=True):
        starts, ends, first = chunk.words()
        word = chunk.spans(starts, ends)
        counts = np.diff(first)
        rolled = np.zeros(max(len(word) - size + 1, 0), dtype=np.uint64)
        for k in range(size):
            rolled = mix(rolled * _STEP + word[k: k + len(rolled)])
        sets = []
        for d in range(chunk.docs):
            n, at = int(counts[d]), int(first[d])
            if n >= size:
                h = np.sort(rolled[at: at + n - size + 1])
                sets.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
            elif n:
                h = np.full(1, _SHORT * n & ((1 << 64) - 1), dtype=np.uint64)
                for k in range(n):
                    h = mix(h * _STEP + word[at + k])
                sets.append(h)
            else:
                sets.append(np.empty(0, np.uint64))
        yield chunk.first, np.array([len(s) for s in sets], dtype=np.int64), np.concatenate(sets)


SIGNED = "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>, signature binary"
BLOCK_BYTES, ROW_BYTES = 4 << 20, 1 << 10  # a row counts as its set and so many bytes: 4,096 rows a block at most


def _signer(size: int, n_bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sizes, hashes in shingle_sets(batch.column(1), size):
                ends = np.cumsum(sizes)
                digests = []
                for salt in (np.uint64(0), _STEP):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + salt), dtype=np.uint64)))
                    digests.append((total[ends] - total[ends - sizes]).view(np.int64))
                signature = signatures(hashes, sizes, n_bands * rows)
                banded = band_hashes(signature, n_bands, rows).view(np.int64)
                short = mix(signature).astype(np.uint8)
                offsets = np.concatenate(([0], np.cumsum(np.where(sizes > 0, n_bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(sizes)), pa.array(sizes), pa.array(digests[0]), pa.array(digests[1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(banded[sizes > 0].reshape(-1))),
                    pa.array([row.tobytes() for row in short], pa.binary()),
                ], ["doc_id", "n_shingles", "digest_a", "digest_b", "bands", "signature"])
    return sign


def _setter(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sizes, hashes in shingle_sets(batch.column(1), size):
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(sizes)),
                    pa.array([hashes[e - n: e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary()),
                ], ["doc_id", "shingles"])
    return sets


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(left, right)
    both = int((left[np.minimum(at, len(left) - 1)] == right).sum())
    return 100 * both >= percent * (len(left) + len(right) - both)


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array([_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                             for x, y in zip(batch.column(2), batch.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
    return verify


def _block_comparer(percent: int, positions: int):
    """Links between the members of a block outside the largest component and those of a block of all."""
    likely = percent / 100
    least = (likely - 5 * (likely * (1 - likely) / positions) ** 0.5) * positions

    def compare(key: tuple, block: pa.Table) -> pa.Table:
        band = key[0].as_py()
        n = block.num_rows
        doc, component, outside = (block[c].to_numpy() for c in ("doc_id", "component", "outside"))
        signature = np.frombuffer(b"".join(block["signature"].to_pylist()), np.uint8).reshape(n, positions)
        shared = block["bands"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in block["shingles"].chunks for x in c]
        size = np.array([len(x) for x in sets])
        forest = UnionFind()
        for d, c in zip((-1 - doc).tolist(), (-1 - component).tolist(), strict=True):
            forest.union(d, c)  # below zero: not a link found here
        links = []
        right = np.flatnonzero(~outside)
        for u in np.flatnonzero(outside):
            alike = (signature[right] == signature[u]).sum(axis=1)
            near = (alike >= least) & (component[right] != component[u]) & (
                100 * np.minimum(size[right], size[u]) >= percent * np.maximum(size[right], size[u]))
            near = np.flatnonzero(near)
            first = (shared[right[near]] == shared[u]).argmax(axis=1)
            near = near[shared[u][first] == band]  # the others meet in an earlier band
            for x in right[near][np.argsort(-alike[near], kind="stable")]:
                a, b = int(doc[u]), int(doc[x])
                if forest.find(-1 - a) == forest.find(-1 - b):
                    continue
                if _linked(sets[u], sets[x], percent):
                    forest.union(-1 - a, -1 - b)
                    links.append((min(a, b), max(a, b)))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return compare


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, n_bands: int = 25, rows: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``; links are pairs with
    ``100 * intersection >= percent * union``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(docs.mapInArrow(_signer(shingle, n_bands, rows), SIGNED), "signed")
    sets = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    whole = ["n_shingles", "digest_a", "digest_b"]
    classes = sets.groupBy(*whole).agg(F.min("doc_id").alias("rep"))
    copies = written(sets.select("doc_id", *whole).join(classes, whole)
                     .select("doc_id", "rep").where("doc_id <> rep").distinct(), "copies")
    reps = sets.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *whole], "left_semi")
    members = reps.select(F.explode("bands").alias("band"), "doc_id", "n_shingles")
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    met = written(members.join(sizes, "band"), "met")
    popular = met.groupBy("doc_id").agg(F.sum("size").alias("meetings"))
    ranked = met.join(popular, "doc_id")
    first = F.max(F.struct("meetings", (-F.col("doc_id")).alias("least"), "n_shingles"))
    hubs = ranked.groupBy("band").agg(first.alias("hub")) \
        .select("band", (-F.col("hub.least")).alias("hub"), F.col("hub.n_shingles").alias("hub_n"))
    starred = written(met.join(hubs, "band"), "starred")
    possible = 100 * F.least("n_shingles", "hub_n") >= percent * F.greatest("n_shingles", "hub_n")
    pairs = written(starred.where(F.col("hub") != F.col("doc_id")).where(possible)
                    .select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct(), "pairs")
    payload = written(docs.where("doc_id IS NOT NULL").join(met.select("doc_id").distinct(), "doc_id", "left_semi")
                      .mapInArrow(_setter(shingle), "doc_id long, shingles binary").where("length(shingles) > 0"), "sets")
    verified = pairs.join(payload.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right")), "b") \
        .join(payload.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left")), "a") \
        .select("a", "b", "left", "right").mapInArrow(_verifier(percent), "a long, b long")
    links = written(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).union(verified).distinct(), "links")
    labels = written(components(links), "labels")
    left = _unsettled(starred.where("doc_id <> hub").select("band", "doc_id"), labels)
    blocks = _blocks(left, reps.select("doc_id", "bands", "signature"), payload)
    more = written(blocks.groupBy("band", "i", "j").applyInArrow(
        _block_comparer(percent, n_bands * rows), "a long, b long").distinct(), "more")
    if not more.isEmpty():
        roots = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
        labels = components(roots.union(more))
    found = signed.select("doc_id", "n_shingles").join(
        labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component: ``band, doc_id, component, outside`` (not of the
    bucket's largest component)."""
    named = members.join(labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left") \
        .select("band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    counts = named.groupBy("band", "component").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts")) \
        .where("parts > 1").select("band", F.col("most.component").alias("most"))
    return written(named.join(mixed, "band").select(
        "band", "doc_id", "component", (F.col("component") != F.col("most")).alias("outside")), "left")


def _blocks(left: DataFrame, signed: DataFrame, payload: DataFrame) -> DataFrame:
    """Each bucket's outside members (blocks i) against all its members (blocks j); a block holds
    ``BLOCK_BYTES`` of sets and one document more at most."""
    bytes_of = payload.select("doc_id", (F.length("shingles") + ROW_BYTES).alias("bytes")).groupBy("doc_id").agg(F.max("bytes").alias("bytes"))
    sized = left.join(bytes_of, "doc_id")
    u = sized.where("outside")
    both = u.union(sized.withColumn("outside", F.lit(False)))
    upto = Window.partitionBy("band", "outside").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("block", F.floor((F.sum("bytes").over(upto) - F.col("bytes")) / BLOCK_BYTES))
    last = both.groupBy("band").agg(F.max(F.when(F.col("outside"), F.col("block"))).alias("last_i"),
                                    F.max(F.when(~F.col("outside"), F.col("block"))).alias("last_j"))
    placed = both.join(last, "band").select(
        "band", "doc_id", "component", "outside", F.explode(F.when(
            F.col("outside"), F.transform(F.sequence(F.lit(0), F.col("last_j")), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))))
            .otherwise(F.transform(F.sequence(F.lit(0), F.col("last_i")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))))
        ).alias("at")).select("band", "doc_id", "component", "outside", "at.i", "at.j")
    return placed.join(signed, "doc_id").join(payload, "doc_id")
