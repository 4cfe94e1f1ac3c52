"""Features are character n-grams, whatever a character's bytes; the language sample is cut before it is ranked."""

import numpy as np
import pyarrow as pa

from stratus.llm import langid
from stratus.llm.subword import Features
from stratus.llm.textbytes import chunks


def test_grams_are_of_characters():
    texts = ["größe ok", "", None, "日本語の本", "ab", "€", "😀😀x😀😀x"]
    features = Features(bits=20, grams=(3, 4))
    got = {row: (bucket, count) for row, bucket, count in features.counts(pa.array(texts))}
    for row, text in enumerate(t or "" for t in texts):
        bucket, count = got[row]
        for kind, n in enumerate((3, 4), 1):
            own = (bucket >> 20) == kind
            grams = [text[i: i + n] for i in range(len(text) - n + 1)]
            assert count[own].sum() == len(grams) and len(bucket[own]) == len(set(grams))


def test_equal_grams_share_a_bucket_across_documents():
    features = Features(bits=20, grams=(3,))
    one, two = (set(b[(b >> 20) == 1].tolist()) for _, b, _ in features.counts(pa.array(["xgrö", "grö"])))
    assert two < one
    (chunk,) = chunks(pa.array(["é", "a"]))
    assert np.array_equal(chunk.characters(), [0, 2, 3])


def test_language_of_one_repeated_row_is_learned(spark, docs):
    rows = [(i, f"the cat sat on mat number {i}", "en", "s") for i in range(300)] + [(7_000_001, "der hund läuft über die straße", "de", "s")] * 400
    rows += [(None, "le chat noir dort ici", "fr", "s")] * 400
    model, _ = langid.fit(docs(rows), sample_rows=60)
    assert set(model.classes) == {langid.LANG + x for x in ("en", "de", "fr")}
