"""Loops that end when they are done, marks that no value can equal, short texts packed as full as long ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import components, langid, linkgraph, mixing, packing
from stratus.llm.registry import tokenizer_path


def test_components_in_one_task_and_in_rounds(spark, monkeypatch):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(30)]
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(4)
    forest = components.UnionFind()
    for a, b in pairs:
        forest.union(a, b)
    wanted = {x: forest.find(x) for a, b in pairs if a != b for x in (a, b)}
    for few in (components.FEW_EDGES, 0):
        monkeypatch.setattr(components, "FEW_EDGES", few)
        got = [tuple(r) for r in components.components(edges).collect()]
        assert len(got) == len(set(got)) and dict(got) == wanted
    assert components.components(edges.limit(0)).count() == 0


def page_rank(edges, seeds, damping):
    """Dense, by solving the linear system."""
    hosts = sorted({h for s, d, _ in edges for h in (s, d)} | set(seeds))
    place = {h: i for i, h in enumerate(hosts)}
    step = np.zeros((len(hosts), len(hosts)))
    for s, d, n in edges:
        step[place[d], place[s]] += n / sum(m for x, _, m in edges if x == s)
    base = np.array([(1 - damping) * seeds.get(h, 0.0) for h in hosts])
    return dict(zip(hosts, np.linalg.solve(np.eye(len(hosts)) - damping * step, base), strict=True))


def test_propagation_settles_where_the_equations_do(spark):
    rng = random.Random(2)
    cycle = [("a", "b", 1), ("b", "a", 1)]
    wide = {(f"h{rng.randrange(30)}", f"h{rng.randrange(30)}") for _ in range(80)}
    wide = [(s, d, rng.randrange(1, 5)) for s, d in sorted(wide) if s != d]
    for edges, seeds in ((cycle, {"a": 1.0}), (wide, {"h1": 1.0, "h2": 0.25, "alone": 0.5})):
        got = linkgraph.propagate(spark.createDataFrame([("trust", *e) for e in edges], "kind string, src string, dst string, n long"),
                                  spark.createDataFrame([("trust", h, x) for h, x in seeds.items()], "kind string, host string, strength double"))
        got, wanted = {r.host: r.score for r in got.collect()}, page_rank(edges, seeds, linkgraph.DAMPING)
        assert all(abs(got.get(h, 0.0) - x) < 1e-5 * len(seeds) for h, x in wanted.items())
    assert abs(page_rank(cycle, {"a": 1.0}, 0.85)["a"] - 0.5405) < 1e-4


def test_verdicts_against_the_equations(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.com" for i in range(30)] + ["x.net", "y.net", "a.org"]
    pages = [(i, f"http://{h}/{'fr/' if h == 'a.org' else ''}p", "".join(f'<a href="http://{t}/">t</a>' for t in rng.sample(hosts, 1)))
             for i, h in enumerate(hosts * 2)]
    rules = [("block", "net", "/"), ("allow", "org", "/fr/")]
    links = {}
    for _, url, html in pages:
        src = url.split("/")[2]
        for dst in {x.split("/")[2] for x in html.split('"') if x.startswith("http")} - {src}:
            links[src, dst] = links.get((src, dst), 0) + 1
    trust = page_rank([(s, d, n) for (s, d), n in links.items()], {"a.org": 1.0}, 0.85)
    distrust = page_rank([(d, s, n) for (s, d), n in links.items()], {"x.net": 1.0, "y.net": 1.0}, 0.85)
    got = linkgraph.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    for r in got:
        wanted = "block" if r.host.endswith(".net") else "allow" if r.host == "a.org" else \
            "block" if distrust.get(r.host, 0) >= linkgraph.LEAST and distrust.get(r.host, 0) > trust.get(r.host, 0) else "allow"
        assert r.verdict == wanted and abs(r.trust - trust.get(r.host, 0)) < 1e-5 and abs(r.distrust - distrust.get(r.host, 0)) < 1e-5
    assert len(got) == len(pages) and len({r.verdict for r in got if r.host.endswith(".com")}) == 2
    assert linkgraph.judge(spark.createDataFrame([], "page_id long, url string, html string"), rules).count() == 0


def test_und_is_a_language_like_any_other(spark, docs):
    rng = random.Random(4)
    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, text("abcdefgh" if i % 2 else "ijklmnop"), "und" if i % 2 else "xx", "s") for i in range(400)]
    told = {r.doc_id: r for r in langid.predict(docs(rows), langid.fit(docs(rows))).collect()}
    assert sum(told[d].rejected for d, *_ in rows) <= 8 and all(told[d].lang_pred == lang for d, _, lang, _ in rows)
    one = [(i, text("abcdefgh"), "?", "s") for i in range(200)]
    strange = [(1000 + i, text("stuvwxyzж"), None, "s") for i in range(20)]
    told = langid.predict(docs(one + strange + [(2000, "12 34", None, "s")]), langid.fit(docs(one))).collect()
    assert all(r.lang_pred == ("und" if r.doc_id == 2000 else "?") and 0 <= r.score <= 1 for r in told)
    assert sum(r.rejected for r in told if r.doc_id >= 1000) >= 19 and sum(r.rejected for r in told if r.doc_id < 1000) <= 4


def test_raking_against_numpy_and_targets_that_cannot_be_met(spark, docs):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(1, 30))), rng.choice("ab"), rng.choice(["s", "t", "t"]))
            for i in range(400)]
    got = mixing.mix(docs(rows), {"lang": {"a": 0.3, "b": 0.7}}).toPandas()
    assert (got.unmet <= mixing.SETTLED).all()
    cells = got.groupby(["source", "lang", "topic"]).agg(tokens=("tokens", "sum"), weight=("weight", "first")).reset_index()
    w = cells.tokens / cells.tokens.sum()
    goals = {"lang": {"a": 0.3, "b": 0.7}}
    for name in ("source", "topic"):
        flat = (cells.groupby(name).tokens.sum()) ** mixing.FLATTEN
        goals[name] = (flat / flat.sum()).to_dict()
    for _ in range(200):
        for name in mixing.MARGINS:
            w = w * cells[name].map(goals[name]) / w.groupby(cells[name]).transform("sum")
    assert np.abs(w - cells.weight).max() < 1e-3
    # each source has one language only: flattened sources and given languages contradict each other
    split = [(d, t, lang, "s" if lang == "a" else "t") for d, t, lang, _ in rows]
    odd = mixing.mix(docs(split), {"lang": {"a": 0.9, "b": 0.1}}).toPandas()
    assert (odd.unmet > 0.1).all() and len(odd) == len(rows) and (odd.probability > 0).all()
    assert mixing.mix(docs([])).count() == 0


@pytest.mark.parametrize("text, n", [("", 20480), ("to be or not", 6000)])
def test_short_texts_fill_their_windows(spark, docs, text, n):
    pieces = packing.pack(docs([(i, text, "en", "s") for i in range(n)]).coalesce(1), tokenizer_path()).toPandas()
    assert len(pieces) == n and (pieces.length == pieces.doc_tokens).all()
    assert pieces.sequence_id.nunique() == -(-int(pieces.length.sum()) // 4096)
    for _, w in pieces.sort_values("offset").groupby("sequence_id"):
        assert w.length.sum() <= 4096 and (w.offset == w.length.cumsum() - w.length).all()


def test_pipeline_keeps_columns_that_clash(spark):
    import corpus_pipeline
    names = ["score", "predicted", "lang_pred", "rejected", "_place", "_others", "label", "kept"]
    frame = corpus_pipeline.table(spark, "/root/testdata/sf0.001", "documents")
    frame = frame.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in names})
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.written(stage(spark, frame, "/root/testdata/sf0.001"), name)
        assert frame.columns == columns and frame.count()
        assert frame.where(" OR ".join(f"`{c}` <> concat('{c} ', doc_id)" for c in names)).count() == 0
