"""Each stage of the pipeline against a plain version of it, over a planted corpus and its given tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import brute_groups

import corpus_pipeline
from stratus.llm import mixing
from stratus.llm.registry import tokenizer_path

SF = "/root/testdata/sf0.001"
CAPITALS = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")  # only these are folded
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def corpus(spark):
    """The given documents, near and exact copies of some, repeated and null rows."""
    rng = random.Random(1)
    given = [tuple(r) for r in corpus_pipeline.table(spark, SF, "documents").select("doc_id", "text", "lang", "source").collect()]
    rows = list(given)
    for i, (_, text, lang, source) in enumerate(rng.sample([r for r in given if len((r[1] or "").split()) > 60], 15)):
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        rows += [(100_000 + i, text.translate(CAPITALS) if i % 2 else text, lang, source), (200_000 + i, " ".join(words), lang, source)]
    rows += [rows[3], (None, "no id " * 30, "en", "s"), (300_000, None, None, None), (300_001, "", "en", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.withColumn("n_chars", F.char_length("text").cast("long"))


def ids(frame):
    return sorted((r.doc_id for r in frame.select("doc_id").collect()), key=str)


def test_near_dedup_keeps_one_of_each_group(spark, corpus):
    kept = STAGES["near_dedup"](spark, corpus, SF)
    rows = {r.doc_id: r.text for r in corpus.collect() if r.doc_id is not None}
    groups = brute_groups(list(rows.items()), 5, 80)
    wanted = [d for d, (_, component) in groups.items() if d == component] + [None]
    assert ids(kept) == sorted(wanted, key=str) and len(wanted) < len(rows)
    assert kept.columns == corpus.columns


def test_quality_and_language_keep_what_is_marked_so(spark, corpus):
    labels = {r.doc_id: r.quality for r in corpus_pipeline.table(spark, SF, "labels").collect()}
    good = set(ids(STAGES["quality"](spark, corpus, SF)))
    marked = [d for d in ids(corpus) if labels.get(d) is not None]
    assert np.mean([(d in good) == (labels[d] == 1) for d in marked]) > 0.95
    told = set(ids(STAGES["language"](spark, corpus, SF)))
    plain = [r.doc_id for r in corpus.collect() if r.doc_id is not None and len(r.text or "") > 200]
    assert np.mean([d in told for d in plain]) > 0.95 and not {300_000, 300_001} & told


def test_mix_draws_by_the_calibrated_probabilities(spark, corpus):
    fate = mixing.mix(corpus, {"lang": corpus_pipeline.LANGUAGE_SHARES}).toPandas()
    kept = STAGES["mix"](spark, corpus, SF)
    assert ids(kept) == sorted((None if np.isnan(d) else int(d) for d in fate[fate.draw < fate.probability].doc_id), key=str)
    words = {r.doc_id: len((r.text or "").split()) for r in corpus.collect()}
    assert all(t == words[None if np.isnan(d) else int(d)] for d, t in zip(fate.doc_id, fate.tokens, strict=True))


def test_pack_holds_every_document_whole(spark, corpus):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = STAGES["pack"](spark, corpus.where("doc_id >= 100000"), SF).toPandas()
    for r in corpus.where("doc_id >= 100000").collect():
        own = pieces[pieces.doc_id == r.doc_id]
        assert own.length.sum() == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
