"""Quality classifier: averaged word and character n-gram vectors, softmax output (see ``subword``).

Trained on a bounded sample: the ``per_label`` labelled documents of each label with the smallest hash of
their id. As both labels then weigh alike, the bias is shifted by their true odds, counted over all
labels. Case and punctuation count as they are; no column but the text is an input of a score.

Defined cases: null text is empty; empty texts get the labels' prior. A document labelled more than once
has the rounded mean (a half counts as good); null labels are left out. Without labels of both kinds every
score is 1 where any label is good or none exists, else 0. A null doc_id counts as empty text in the hold-out rule.
Repeated rows are scored each. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.subword import Features, Model, learned, train
from stratus.llm.tables import held_out

FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3
PER_LABEL = 1500
FEATURES = Features(bits=15, grams=(3, 4), lower=False, repeats=True)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model | float:
    """A model, or the one score that all texts get where there is nothing to tell apart."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id") \
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label")).where(~held_out("doc_id", FOLDS, HELD_FOLD))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return 0.0 if 0 in counts else 1.0
    parts = [known.where(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for x in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # at most 2 * per_label ids
    texts = docs.select("doc_id", "text").join(chosen, "doc_id") \
        .orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(2 * per_label).select("label", "text")
    odds = math.log(counts[1] / counts[0])

    def learn(sample: list) -> Model | float:
        n = [sum(label == x for label, _, _ in sample) for x in ("0", "1")]
        if not all(n):
            return 0.0 if not n[1] and n[0] else 1.0
        model = train(sample, ("0", "1"), FEATURES)
        return replace(model, bias=model.bias + np.array([0.0, odds - math.log(n[1] / n[0])]))

    return learned(texts, FEATURES, learn)


def score(docs: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` behind its own columns; columns of these names are replaced."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*keep)
    if not isinstance(model, Model):
        return docs.withColumn("score", F.lit(float(model))).withColumn("predicted", F.lit(int(model >= threshold)))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets: 2 MB
    at = keep.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.scores(batch.column(at))[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    for f in schema:
        f.nullable = True
    return docs.mapInArrow(apply, schema)
