"""How the sources of a language differ in their use of terms.

1. Tasks count (lang, source, term) occurrences and documents by length-bucketed packing (``term_packing``),
   chunk by chunk; Spark adds the counts up, dealt by (lang, term), so a source holding a third of all rows is spread over
   its terms and a frequent term comes once a chunk and group.
2. Terms in at least ``least`` documents of their language are kept. Every group (lang, source) and every
   language gives each kept term the exact integer ``p = 1 + floor(scale * (count + add) / (N + add * V))``.
3. Terms: those a group uses more than its language, the best ``top`` per group (a window limited before the
   shuffle).
4. Pairs: the sum of absolute differences over all kept terms. A language's terms are dealt into blocks; a task
   holds the matrix (sources x the block's terms, where a source without a term has its p of count 0) and gives partial sums for
   some of the sources against all; the sums are added up. Matrices and partial results are bounded.

Defined cases: null text, lang or source is the empty string. Each row is a document, repeated doc_ids too.
A language without kept terms has pairs of value 0 and no terms; a group without terms takes part in pairs. A
language with one source has no pairs. Very long texts and terms are taken whole. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.tables import written
from stratus.llm.term_packing import count_terms

SCALE, ADD = 1_000_000_000, 5
CHUNK_BYTES = 4 << 20
CELLS, TERMS = 1 << 17, 256  # of a block's matrix, about; terms of a block where there are many sources
SUMS = 1 << 20  # rows that a task gives out, about
COUNTED = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _gathered(batches):
        keys = batch.select(["lang", "source"]).to_pandas()
        group = keys.groupby(["lang", "source"], sort=False).ngroup().to_numpy()
        names = keys.drop_duplicates()
        lang, source = (pa.array(names[c].to_numpy(), pa.string()) for c in ("lang", "source"))
        for g, term, n, docs in count_terms(batch["text"].combine_chunks(), group, CHUNK_BYTES):
            g = pa.array(g)
            yield pa.RecordBatch.from_arrays([lang.take(g), source.take(g), term.cast(pa.string()), pa.array(n), pa.array(docs)],
                                             ["lang", "source", "term", "n", "docs"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined until they hold a chunk of text: fewer and larger runs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def term_counts(docs: DataFrame, least: int = 30) -> DataFrame:
    """``lang, source, term, n, n_lang`` for the kept terms of ``docs(text, lang, source)`` where they occur (n > 0)."""
    counted = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))) \
        .mapInArrow(_count, COUNTED)
    cells = written(counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    kept = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")) \
        .where(F.col("docs") >= least).select("lang", "term", "n_lang")
    return written(cells.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "kept_terms")


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(scale * (n + add) / (total + add * v)), exact."""
    wide = "decimal(20,0)"
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(11,0)") * (n + ADD).cast(wide), (total + ADD * v).cast(wide))


def _pair_sums(key: tuple, block: pa.Table) -> pa.Table:
    """Partial sums of one block of terms: sources ``part, part + parts, ...`` against all other sources."""
    part, parts = key[2].as_py(), block["parts"][0].as_py()
    mark = block["term"].is_null()
    base = block.filter(mark).sort_by("source")
    sources = base["source"].combine_chunks()
    cells = block.filter(pc.invert(mark))
    row = pc.index_in(cells["source"], sources).to_numpy()
    terms, column = np.unique(cells["term"].to_numpy(), return_inverse=True)
    p = np.repeat(base["p"].to_numpy()[:, None], len(terms), axis=1)
    p[row, column] = cells["p"].to_numpy()
    own = np.arange(part, len(sources), parts)
    values = np.stack([np.abs(p - p[i]).sum(axis=1) for i in own]) if len(own) else np.empty((0, len(sources)), np.int64)
    i, j = np.repeat(own, len(sources)), np.tile(np.arange(len(sources)), len(own))
    other = i != j
    return pa.table({"lang": pa.array([key[0].as_py()] * int(other.sum()), pa.string()), "source": sources.take(pa.array(i[other])),
                     "item": sources.take(pa.array(j[other])), "value": pa.array(values.reshape(-1)[other], pa.int64())})


def divergence(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has every other source of the language, part
    ``term`` the terms that set the group off from its language."""
    kept = term_counts(docs, least)
    per_lang = kept.groupBy("lang", "term").agg(F.max("n_lang").alias("n")).groupBy("lang").agg(
        F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    width = every.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("long")
    groups = every.join(totals, ["lang", "source"], "left").join(per_lang, "lang", "left").join(width, "lang") \
        .select("lang", "source", "sources", *(F.coalesce(c, zero).alias(c) for c in ("total", "v", "lang_total")))
    terms_each = F.greatest(F.lit(CELLS) / F.col("sources"), F.lit(float(TERMS)))
    groups = written(groups.withColumn("blocks", F.greatest(F.ceil(F.col("v") / terms_each), F.lit(1)))
                     .withColumn("parts", F.ceil(F.col("sources") * F.col("sources") / SUMS)), "groups")
    cells = written(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "blocks", "parts", share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("n_lang"), F.col("lang_total"), F.col("v")).alias("q")), "cells")

    terms = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        (F.col("p") - F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    each = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("some")
    base = groups.where("sources > 1").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), "parts",
        F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v"))).otherwise(zero).alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("block"))
    dealt = cells.select("lang", "source", "term", "parts", "p", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
    placed = base.unionByName(dealt).select("*", each)
    sums = placed.groupBy("lang", "block", "some").applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")) \
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))
    return pairs.unionByName(terms)
