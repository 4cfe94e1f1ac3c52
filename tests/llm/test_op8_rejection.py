"""Every language is learned, and texts of none of them are rejected."""

import random

import pytest

from stratus.llm import langid

LETTERS = ["abcdefgh", "ijklmnop"]


def text(rng, letters, n=40):
    return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))


@pytest.mark.parametrize("n", [1, 2])
def test_gibberish_is_rejected(spark, docs, n):
    rng = random.Random(4)
    rows = [(i, text(rng, LETTERS[i % n]), f"l{i % n}", "s") for i in range(800)]
    strange = [(5000 + i, text(rng, "qrstuvwxyz\u0436\u4e2d"), None, "s") for i in range(50)]
    told = {r.doc_id: r for r in langid.predict(docs(rows + strange), langid.fit(docs(rows))).collect()}
    assert sum(told[d].rejected for d, *_ in strange) >= 45
    assert sum(told[d].rejected for d, *_ in rows) <= 16
    assert all(told[d].lang_pred == lang for d, _, lang, _ in rows if not told[d].rejected)


def test_more_than_a_hundred_languages(spark, docs):
    rng = random.Random(7)
    words = [[text(rng, "abcdefghijklmnopqrstuvwxyz", 1) for _ in range(15)] for _ in range(120)]
    rows = [(i, " ".join(rng.choice(words[i % 120]) for _ in range(40)), f"l{i % 120}", "s") for i in range(120 * 24)]
    model, threshold = langid.fit(docs(rows))
    assert len(model.classes) == 120
    told = langid.predict(docs(rows), (model, threshold)).collect()
    assert sum(r.lang_pred == r.lang for r in told) > 0.9 * len(rows)
