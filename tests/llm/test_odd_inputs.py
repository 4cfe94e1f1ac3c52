"""Empty tables, clashing columns, repeated rows and very long texts: defined results for every operator."""

import random

import pytest
from pyspark.sql import functions as F

from stratus.llm import block_ann, block_topk, chat, langid, linkgraph, mixing, packing, quality, templates
from stratus.llm.neardup import near_duplicates
from stratus.llm.registry import URL_RULES, tokenizer_path

CLASH = ["score", "predicted", "lang_pred", "rejected", "host", "path", "rule", "verdict", "rank", "label", "band", "rep", "draw",
         "tokens", "weight", "template", "page", "turns", "turn_no", "n", "component", "bands", "_letters", "norm", "block"]
LONG = "word and another one, " * 40_000


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30)), "aa" if i % 2 else "bb", f"s{i % 3}") for i in range(40)]
    rows += [(100, LONG, "aa", "s0"), (101, None, None, None), (102, "", "bb", ""), rows[0], rows[0], (None, "no id", "aa", "s1")]
    pages = [(i, f"http://h{i % 3}.org/", f"<article><p>page {i}</p></article>") for i in range(6)]
    pages += [(10, "http://h0.org/" + "x" * 100_000, f"<p>{LONG}</p><a href=//h1.org/>l</a>"), pages[0], (None, None, None)]
    turns = [(1, 0, "user", LONG), (1, 1, "assistant", LONG), (2, 0, None, None), (2, 0, None, None), (None, None, "assistant", "x")]
    vectors = [(i, [float(rng.random()) for _ in range(8)]) for i in range(60)] + [(None, [1.0] * 8), (61, None)]
    made = {"docs": spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"),
            "labels": spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int"),
            "pages": spark.createDataFrame(pages, "page_id long, url string, html string"),
            "turns": spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
            "vectors": spark.createDataFrame(vectors, "vec_id long, embedding array<float>")}
    return made


OPERATORS = {
    "chat": lambda t: chat.read_back(chat.format_conversations(t["turns"])),
    "neardup": lambda t: near_duplicates(t["docs"]),
    "packing": lambda t: packing.pack(t["docs"], tokenizer_path()),
    "linkgraph": lambda t: linkgraph.judge(t["pages"], URL_RULES),
    "block_topk": lambda t: block_topk.top_k(t["vectors"], "vec_id % 10 = 0"),
    "quality": lambda t: quality.score(t["docs"].select("doc_id", "text", *extra(t["docs"])), quality.fit(t["docs"], t["labels"])).select("doc_id", "score", "predicted"),
    "block_ann": lambda t: block_ann.nearest(t["vectors"], "vec_id % 10 = 0"),
    "langid": lambda t: langid.predict(t["docs"], langid.fit(t["docs"])).select("doc_id", "lang_pred", "score", "rejected"),
    "templates": lambda t: templates.extract(t["pages"]),
    "mixing": lambda t: mixing.mix(t["docs"]),
}


def extra(df):
    return [c for c in CLASH if c in df.columns]


def rows_of(df):
    cols = [c for c in df.columns if c != "sequence_id"]
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_inputs(spark, tables, name):
    plain = rows_of(OPERATORS[name](tables))
    assert plain
    one = {k: df.coalesce(1) for k, df in tables.items()}
    clashing = {k: df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns}) for k, df in one.items()}
    assert rows_of(OPERATORS[name](clashing)) == rows_of(OPERATORS[name](one))
    assert rows_of(OPERATORS[name]({k: df.limit(0) for k, df in tables.items()})) == []
    given = {"linkgraph": "pages", "templates": "pages", "neardup": "docs", "quality": "docs", "langid": "docs", "mixing": "docs"}
    if name in given:  # a row for each row
        assert len(plain) == tables[given[name]].count()
