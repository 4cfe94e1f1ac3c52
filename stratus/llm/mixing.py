"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents fall into cells (source, language, topic). Raking multiplies the cells' token weights by one
factor for each source, language and topic in turn until all three marginals of the weighted tokens match
their targets. Cells are few compared with documents; they are summed in Spark with partial sums, each
sweep is grouped sums over the cell table, cut by a written table, and only one number a sweep (the
largest marginal error) comes to the driver.

A cell's tokens are then to be kept in proportion to its raked weight. The rate is calibrated so that the
expected kept tokens are ``keep`` of all, cells that would need more than all of their tokens being kept
whole (no document is taken twice). A document is kept when the hash of its id, its text and the seed, read as a number
between 0 and 1, is below its cell's probability: the same documents in every run and after lost executors.

Tokens are white-space separated words. A document's topic is the class that most of its long words
(seven bytes or more) hash to, of ``TOPICS`` classes; without long words it is class 0.

Defined cases: null source or language is a value of its own. Null or empty text has no tokens; a cell without
tokens is kept whole, as it moves no marginal. Targets that the cells that exist cannot all meet (a source with one language only)
are raked until two sweeps lower the largest marginal error by less than a twentieth; each row's ``unmet`` says how large that is. Repeated rows have the same fate. A target left out for a value shares what the
others leave equally; if they leave nothing, it keeps the share of its tokens and the given ones share the rest. Without any target a
marginal is flattened: the shares of its tokens to the power ``FLATTEN``.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratus.llm.tables import written
from stratus.llm.textbytes import chunks

TOPICS, LONG_WORD = 8, 7
FLATTEN = 0.5
NOTHING = 1e-9  # given shares that sum up to 1 but for rounding leave nothing
KEEP = 0.5
SWEEPS, SETTLED, STALLED = 1000, 1e-4, 0.95  # an error above STALLED times that of two sweeps before stays
MARGINS = ("source", "lang", "topic")


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column(1), lower=True):
            starts, ends, first = chunk.words()
            long = ends - starts >= LONG_WORD
            doc = np.repeat(np.arange(chunk.docs), np.diff(first))
            topic = (chunk.spans(starts, ends) % np.uint64(TOPICS)).astype(np.int64)
            votes = np.bincount(doc[long] * TOPICS + topic[long], minlength=chunk.docs * TOPICS).reshape(chunk.docs, TOPICS)
            rows = slice(chunk.first, chunk.first + chunk.docs)
            part = batch.slice(rows.start, chunk.docs)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *part.columns[2:], pa.array(votes.argmax(axis=1).astype(np.int32)), pa.array(np.diff(first).astype(np.int64))],
                ["doc_id", "source", "lang", "draw", "topic", "tokens"])


def _target(cells: DataFrame, name: str, given: dict | None) -> DataFrame:
    """``name, goal``: the share of all tokens that each value of a marginal is to have."""
    sums = cells.groupBy(name).agg(F.sum("tokens").alias("t"))
    if given:
        left = 1.0 - sum(given.values())
        goal = F.lit(None).cast("double")
        for value, share in given.items():
            goal = F.when(F.col(name).eqNullSafe(F.lit(value)), float(share)).otherwise(goal)
        sums = sums.withColumn("g", goal)
        others = sums.agg(F.count(F.when(F.col("g").isNull(), 1)).alias("others"), F.sum("t").alias("all_t"),
                          F.sum("g").alias("all_g"), F.sum(F.when(F.col("g").isNotNull(), F.col("t"))).alias("given_t"))
        sums = sums.crossJoin(F.broadcast(others))  # one row
        if left > NOTHING:
            other = F.lit(left) / F.col("others")
        else:  # others : given = their tokens : the given ones' tokens
            other = F.when(F.col("given_t") > 0, F.col("t") * F.col("all_g") / F.col("given_t")).otherwise(F.col("t"))
        given_p = F.when(F.col("given_t") > 0, F.col("g")).otherwise(0.0) if left <= NOTHING else F.col("g")
        sums = sums.withColumn("p", F.when(F.col("g").isNull(), other).otherwise(given_p))
    else:
        sums = sums.withColumn("p", F.pow("t", F.lit(FLATTEN)))
    total = F.broadcast(sums.agg(F.sum("p").alias("all")))  # one row
    return sums.crossJoin(total).select(name, (F.col("p") / F.col("all")).alias("goal"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, settled: float = SETTLED) -> DataFrame:
    """``cells(source, lang, topic, tokens)`` with ``weight``: tokens scaled so that every marginal's share is
    its goal, as far as the cells that exist allow, and ``unmet``, the largest error left. Sweeps go on until the error is
    settled or stays (``STALLED``), which takes some 340 sweeps at the very most; without either it raises."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(float(max(total, 1))))
    for name in MARGINS:
        cells = cells.join(targets[name].select(F.col(name).alias(f"_{name}"), F.col("goal").alias(f"goal_{name}")),
                           F.col(name).eqNullSafe(F.col(f"_{name}"))).drop(f"_{name}")
    cells = written(cells, "cells")
    errors: list[float] = []
    for _ in range(sweeps):
        new = cells
        for name in MARGINS:
            sums = new.groupBy(F.col(name).alias(f"_{name}")).agg(F.sum("weight").alias("have"))
            new = new.join(sums, F.col(name).eqNullSafe(F.col(f"_{name}")))
            new = new.withColumn(f"off_{name}", F.abs(F.col("have") - F.col(f"goal_{name}"))) \
                .withColumn("weight", F.when(F.col("have") > 0, F.col("weight") * F.col(f"goal_{name}") / F.col("have")).otherwise(0.0)) \
                .drop("have", f"_{name}")
        seen = Observation()
        new = written(new.observe(seen, F.greatest(*(F.max(f"off_{name}") for name in MARGINS)).alias("off")), "cells")
        off = seen.get.get("off") or 0.0
        cells = new.drop(*(f"off_{name}" for name in MARGINS))
        errors.append(off)
        if off <= settled or len(errors) > 2 and off > STALLED * errors[-3]:
            return cells.withColumn("unmet", F.lit(float(off)))
    raise RuntimeError(f"raking did not settle in {sweeps} sweeps: a marginal is off by {errors[-1]}")


def calibrate(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """``cells`` with ``probability``: min(1, rate * weight / tokens), the rate such that the expected kept
    tokens are ``keep`` of all. Each round one sum; capped cells only grow in number, so it ends."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rate, capped = 0.0, -1
    while True:
        full = (F.lit(rate) * F.col("weight") >= F.col("tokens")) & (F.col("tokens") > 0)
        r = cells.agg(F.sum(F.when(full, F.col("tokens"))).alias("whole"), F.count(F.when(full, 1)).alias("n"),
                      F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if r["n"] == capped or not r["open"]:
            break
        capped = r["n"]
        rate = max(rate, (keep * total - (r["whole"] or 0)) / r["open"])
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, F.least(
        F.lit(1.0), F.lit(float(rate)) * F.col("weight") / F.col("tokens"))).otherwise(1.0))


def _draw(seed: int):
    """A number from 0 to 1 by the row's id and text."""
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))


def mix(docs: DataFrame, targets: dict[str, dict] | None = None, keep: float = KEEP, seed: int = 11) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, weight`` (raked share of the document's cell), ``probability,
    draw, selected, unmet`` for every row of ``docs(doc_id, text, source, lang)``."""
    rows = written(docs.select("doc_id", F.col("text").cast("string").alias("text"), "source", "lang", _draw(seed).alias("draw"))
                   .mapInArrow(_describe, "doc_id long, source string, lang string, draw double, topic int, tokens long"), "described")
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    goals = {name: _target(cells, name, (targets or {}).get(name)) for name in MARGINS}
    drawn = calibrate(rake(cells, goals), keep).select(
        *(F.col(name).alias(f"_{name}") for name in MARGINS), "weight", "probability", "unmet")
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in MARGINS]
    return rows.join(drawn, same, "left").select(
        "doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "draw",
        (F.col("draw") < F.col("probability")).alias("selected"), "unmet")


def selected(docs: DataFrame, targets: dict[str, dict] | None = None, keep: float = KEEP, seed: int = 11) -> DataFrame:
    """The rows of ``docs`` that the mix keeps, with their own columns."""
    fate = mix(docs, targets, keep, seed).where("selected").select(F.col("doc_id").alias("_id"), F.col("draw").alias("_draw")).distinct()
    same = docs["doc_id"].eqNullSafe(fate["_id"]) & (_draw(seed) == fate["_draw"])
    return docs.join(fate, same, "left_semi")
