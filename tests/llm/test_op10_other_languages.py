"""Values without a target keep a share where the given ones leave none."""

import random

from stratus.llm import mixing
from stratus.llm.registry import LANGUAGE_SHARES


def test_fifth_language_and_null(spark, docs):
    rng = random.Random(9)
    langs = ["en", "de", "fr", "es", "it", None]
    rows = [(i, " ".join(f"w{rng.randrange(999)}longer" for _ in range(rng.randrange(5, 40))), langs[i % 6],
             "italian" if i % 12 == 4 else f"s{i % 2}") for i in range(3000)]
    got = mixing.mix(docs(rows), {"lang": LANGUAGE_SHARES}, keep=0.4).toPandas()
    assert (got.probability > 0).all() and got[got.source == "italian"].selected.any()
    kept, lang = got[got.selected], lambda d: d.lang.fillna("none")
    share = kept.groupby(lang(kept)).tokens.sum() / kept.tokens.sum()
    own = got.groupby(lang(got)).tokens.sum() / got.tokens.sum()
    rest = 1 - own["it"] - own["none"]
    for name, goal in [("it", own["it"]), ("none", own["none"]), *((k, v * rest) for k, v in LANGUAGE_SHARES.items())]:
        assert abs(share[name] - goal) < 0.05
    only = mixing.mix(docs([r for r in rows if r[2] == "it"]), {"lang": LANGUAGE_SHARES}).toPandas()
    assert (only.probability > 0).all()
