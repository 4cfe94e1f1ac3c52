"""Language identification: averaged hashed subword vectors, linear softmax, calibrated rejection (see ``subword``).

Languages are all values of ``lang``. Trained on a bounded sample: of each language the documents with the
smallest hash of their id, ``SAMPLE_ROWS`` in all, or ``LEAST_ROWS`` a language where that is more. A fifth of
each language's sample is kept from training; on it the temperature is set, and the rejection threshold: the
probability that all but ``REJECT_SHARE`` of its documents reach, at most halfway from chance to certainty
(a small sample's least sure document is no measure of its share). Where a single language is learned, the
same documents with their features thrown into random buckets are a second class, so that there is
something to tell it from; what is told as that class gets the learned language, with its probability, and is rejected.

Defined cases: null text or text without a letter is ``und`` with score 0 and rejected. ``und`` may be a learned
language as any other. With nothing to learn from (an empty table too), every text is ``und``. Very long texts are scored whole. Null lang is not learned. A null doc_id counts as empty text in the
hold-out rule. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.subword import Features, Model, calibrated, learned, probabilities, train
from stratus.llm.tables import held_out

FOLDS, HELD_FOLD = 4, 2
SAMPLE_ROWS, LEAST_ROWS, SPARE_ROWS, REJECT_SHARE = 3000, 20, 100, 0.001
HASHES = 1 << 40
UNKNOWN = "und"
LANG, STRANGE = "=", "?"  # class names: a language behind LANG, so that none is the strange class
FEATURES = Features(bits=15, grams=(3,), lower=True)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Model, float] | None:
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out("doc_id", FOLDS, HELD_FOLD))
    known = known.select("lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)).alias("h"))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("ids"), F.min("h").alias("least")).collect()
    if not counts:  # one row a language, as in the model
        return None
    each = max(LEAST_ROWS, sample_rows // len(counts))
    # hashes are even: up to this one a language has twice ``each`` ids and some more; only their rows are ranked
    cuts = [(r["lang"], max(r["least"], int(HASHES * min(1.0, (2 * each + SPARE_ROWS) / r["ids"])))) for r in counts]
    schema = T.StructType([T.StructField("lang", docs.schema["lang"].dataType), T.StructField("cut", T.LongType())])
    near = known.join(F.broadcast(docs.sparkSession.createDataFrame(cuts, schema)), "lang").where("h <= cut")
    order = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    rows = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    return learned(rows.select(F.concat(F.lit(LANG), F.col("lang").cast("string")).alias("label"), "text"), FEATURES, _learn)


def _learn(sample: list) -> tuple[Model, float]:
    if len({label for label, _, _ in sample}) == 1:
        sample = sample + _scattered(sample)
    classes = tuple(sorted({label for label, _, _ in sample}))
    place: Counter = Counter()
    kept_out, taught = [], []
    for x in sample:
        (kept_out if place[x[0]] % 5 == 4 else taught).append(x)
        place[x[0]] += 1
    model = calibrated(train(taught, classes, FEATURES), kept_out)
    known = [x for x in kept_out if x[0] != STRANGE]
    if not known:
        return model, 0.0
    sure = probabilities(model, known, model.temperature).max(axis=1)
    return model, min((1 + 1 / len(classes)) / 2, float(np.quantile(sure, REJECT_SHARE)))


def _scattered(sample: list) -> list:
    """The documents with each feature in a random bucket of its kind."""
    rng = np.random.default_rng(5)
    return [(STRANGE, (bucket >> FEATURES.bits << FEATURES.bits) + rng.integers(0, 1 << FEATURES.bits, len(bucket), dtype=np.int32), count)
            for _, bucket, count in sample]


def predict(docs: DataFrame, fitted: tuple[Model, float] | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` behind its own columns; columns of these names are
    replaced."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    docs = docs.select(*keep)
    if fitted is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # a fixed number of buckets, a row of ``dim`` numbers each
    at, flag = keep.index("text"), len(keep)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, threshold = shared.value
        names = np.array([c.removeprefix(LANG) for c in model.classes], dtype=object)
        strange = np.array([c == STRANGE for c in model.classes])
        for batch in batches:
            letters = batch.column(flag).to_numpy(zero_copy_only=False)
            p = model.scores(batch.column(at))
            odd = strange[p.argmax(axis=1)]
            p = np.where(strange, -1.0, p)
            top = p.argmax(axis=1)
            score = np.where(letters, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:flag], pa.array(np.where(letters, names[top], UNKNOWN), pa.string()), pa.array(score),
                pa.array(~letters | (score < threshold) | odd)], [*keep, "lang_pred", "score", "rejected"])

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema
    for f in schema:
        f.nullable = True
    fresh = "_letters" + "_" * max(map(len, keep))  # longer than any other name
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(fresh)
    return docs.select("*", letters).mapInArrow(apply, schema)
