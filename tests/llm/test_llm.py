"""Operators of the llm subpackage against brute force, round trips, planted cases and odd input."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stratus.llm import block_ann, block_topk, chat, langid, linkgraph, mixing, neardup, packing, quality, templates
from stratus.llm.components import components
from stratus.llm.registry import URL_RULES, tokenizer_path
from stratus.llm.superminhash import signatures
from stratus.llm.textbytes import chunks, mix

WORDS = [a + b for a, b in itertools.product(["ka", "lo", "mi", "ne", "pu", "ra", "si", "to"], repeat=2)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def test_words_across_documents():
    texts = ["a bc a", "", None, "Bc", "x.y, zé\tz", "q"]
    found = [[bytes(c.data[a:b]).decode() for a, b in zip(*c.words()[:2])] for c in chunks(pa.array(texts), True, 3)]
    assert sum(found, []) == ["a", "bc", "a", "bc", "x.y,", "zé", "z", "q"]


def test_superminhash_estimates_and_stops():
    rng = np.random.default_rng(1)
    base = mix(rng.integers(1, 1 << 62, 400).astype(np.uint64))
    a, b = base[:360], base[40:]
    s = signatures(np.concatenate((a, b, base[:3])), np.array([360, 360, 3]), 512)
    assert abs((s[0] == s[1]).mean() - 320 / 400) < 0.08
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_chat_round_trip_and_mask(spark):
    nasty = "a\\ </turn><turn>user\nb \\</turn> \\\\"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 2, "user", None), (1, 3, "assistant", "x"),
            (2, 0, None, "only"), (None, 0, "we\nird", "t"), (3, 0, "assistant", ""), (3, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns)
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert back[1].n_turns == 4 and back[1].loss_chars == len(nasty) + 1
    assert back[2].n_turns == 1 and back[2].loss_chars == 0 and back[None].n_turns == 1 and back[3].n_turns == 2
    import hashlib
    shown = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows[:4])
    assert back[1].turns_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    full = {(r.conv_id, r.turn_no): r for r in chat.with_context(formatted).collect()}
    short = {(r.conv_id, r.turn_no): r for r in chat.prefix_target_examples(formatted).collect()}
    assert full.keys() == short.keys() and all(full[k].target == short[k].target for k in full)
    assert len(full[1, 3].context) == short[1, 3].context_chars and full[1, 3].target == "x</turn>"


def brute_groups(rows, size, percent):
    sets = {}
    for d, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").lower()) if x]
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {d: d for d in sets}
    def root(d):
        while label[d] != d:
            d = label[d]
        return d
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_near_duplicates_against_brute_force(spark, docs):
    rng = random.Random(3)
    rows, base = [], prose(rng, 150).split()
    for i in range(120):  # a family that is linked in part, so blocks are compared
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((i, " ".join(w)))
    rows += [(200 + i, prose(rng, 40)) for i in range(20)] + [(300, rows[5][1].upper()), (301, None), (302, " \n"), (303, "one two"), (304, "One  TWO")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(
        docs([(d, t, "en", "s") for d, t in rows]), shingle=3, percent=85).collect()}
    assert got == brute_groups(rows, 3, 85)
    assert neardup.near_duplicates(docs([])).count() == 0


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[101] == 100


def test_packing_pieces_and_padding(spark, docs):
    from tokenizers import Tokenizer
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([1, 30, 300, 4000])) + rng.choice([".", ", Don't <|endoftext|> É", "\x1c!"]), "en", "s") for i in range(40)]
    rows += [(98, None, None, None), (99, "", None, None), (None, "Kelvin \u212a", None, None)]
    t = Tokenizer.from_file(tokenizer_path())
    pieces = packing.pack(docs(rows), tokenizer_path()).toPandas()
    for doc_id, text, _, _ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = pieces[pieces.doc_id.isna() if doc_id is None else pieces.doc_id == doc_id].sort_values("start")
        assert own.length.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        for p in own.itertuples():
            assert zlib.crc32(ids[p.start: p.start + p.length].tobytes()) == p.ids_crc32
    for _, w in pieces.sort_values("offset").groupby("sequence_id"):
        assert w.length.sum() <= 4096 and (w.offset == w.length.cumsum() - w.length).all()
    assert packing.pack(docs([]), tokenizer_path()).count() == 0


def test_differencing_balances():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 1000) for _ in range(300)]
    windows = packing.difference(sizes, 40)
    assert sorted(i for w in windows for i in w) == list(range(300))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 60


def test_rules_and_propagation(spark):
    link = '<a href="http://{}/">x</a>'
    pages = [(1, "https://A.Example.NET/en/1?x", ""), (2, "http://b.net/x", link.format("c.com")),
             (3, "http://c.com/", link.format("b.net") + link.format("b.net")), (4, "http://d.com/", link.format("c.com")),
             (5, "http://x.example.com/de/", ""), (6, None, None), (7, "nohost", "<p>"), (8, "http://net", ""), (9, "ftp://q.org/fr/?#", "")]
    got = {r.page_id: r for r in linkgraph.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2].rule == "net/" and got[5].verdict == "block" and got[9].rule == "org/fr/"
    assert got[3].rule is None and got[3].verdict == "block" and got[3].distrust > 0  # links to a blocked host
    assert (got[6].host, got[6].path, got[6].verdict) == ("", "", "allow") and got[7].host == "" and got[8].rule is None


@pytest.mark.parametrize("search, score", [
    (block_topk.top_k, lambda a, b: int((np.floor(256 * a) * np.floor(256 * b)).sum())),
    (block_ann.nearest, lambda a, b: float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())))])
def test_vector_search_is_exact(spark, search, score):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(300, 16)).astype(np.float32)
    data[7] = data[8]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    bad = [(900, None), (901, [None] * 16), (902, [float("nan")] * 16), (903, []), (904, [1.0, 2.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {}
    for r in search(table, "vec_id % 50 = 0").collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    v = data.astype(np.float64)
    for q in range(0, 300, 50):
        best = sorted(((-score(v[q], v[d]), d) for d in range(300) if d != q))[:5]
        assert [got[q][k + 1][0] for k in range(5)] == [d for _, d in best]
        assert all(abs(got[q][k + 1][1] + s) < 1e-9 for k, (s, _) in enumerate(best))
    assert search(table.limit(0), "vec_id % 50 = 0").count() == 0


def test_quality_and_language(spark, docs):
    rng = random.Random(6)
    other = ["zwölf", "größe", "straße", "über", "schön"]
    rows = [(i, prose(rng, 40), "xx", "s") if i % 2 else (i, " ".join(rng.choice(other) + rng.choice(other) for _ in range(40)), "yy", "s") for i in range(200)]
    rows = [(d, t if d % 10 > 2 else " ".join(w + "!!" for w in t.upper().split()), lang, s) for d, t, lang, s in rows]
    frame = docs(rows + [(1000, None, None, None), (1001, "", "xx", None), (1002, "12 34", None, None)])
    labels = spark.createDataFrame([(d, int(d % 10 > 2), 0) for d, *_ in rows] + [(1, None, None)], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r for r in quality.score(frame, quality.fit(frame, labels)).collect()}
    assert len(scored) == 203 and np.mean([scored[d].predicted == int(d % 10 > 2) for d, *_ in rows]) > 0.97
    assert scored[1000].score is not None
    assert quality.score(frame, quality.fit(frame, labels.limit(0))).where("predicted = 1").count() == 203
    told = {r.doc_id: r for r in langid.predict(frame, langid.fit(frame)).collect()}
    assert np.mean([told[d].lang_pred == lang for d, _, lang, _ in rows]) > 0.97
    assert told[1000].lang_pred == told[1001].lang_pred == told[1002].lang_pred == "und" and told[1000].rejected
    assert langid.predict(frame, None).where("rejected").count() == 203


def test_templates(spark):
    page = "<html><body><nav>m{0}</nav><article><h1>T{0} &amp; t</h1><p><b>x\n y<br>z<p>w</article><footer>f</footer></body>"
    bare = "<body><div>Welcome to the site</div><div><p>own words {0}</div><div class='comments'>c</div><script>var a='<p>'</script></body>"
    rows = [(i, "http://a.org/", page.format(i)) for i in range(3)] + [(10 + i, "http://b.org/", bare.format(i)) for i in range(8)]
    rows += [(20 + i, "http://c.org/", bare.format("same")) for i in range(8)] + [(30, None, None), (31, "x", "<<p>a<p")]
    got = {r.page_id: r for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "T1 & t x y z w" and got[1].n_chars == len(got[1].text)
    assert got[12].text == "own words 2"  # the greeting stands on eight different pages of its host
    assert got[20].text == "Welcome to the site own words same"  # copies of one page are one page
    assert got[30].text == "" and len(got) == len(rows)


def test_templates_keep_what_some_pages_share(spark):
    page = "<body><div>Menu of the site</div><h2>Introduction</h2><p>From <a>Berlin</a>, <em>not</em> {0}{1}<table><tr><td>0</td><td>{0}</td></table></body>"
    quote = "<blockquote>To be or not</blockquote>"
    rows = [(i, "http://d.org/", page.format(f"word{i}", quote if i < 12 else "")) for i in range(40)]
    got = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert got[i] == f"Introduction From Berlin, not word{i}{' To be or not' if i < 12 else ''} 0 word{i}"


def test_templates_names_do_not_drop_the_page(spark):
    pages = ["<body class=x><div class='has-sidebar'><article>own text<div class='sidebar'>s</div></article></div><div class='related'><article>t</article></div>",
             "<div class='page sidebar'><article>own text</article></div>", "<div id=header><p>own</p> text</div><div class=menu>m</div>",
             "<article><p class='entry-header'>own</p><p class='social-science'>text</p><div class='my comments'>c</div></article>"]
    rows = [(i, f"http://e{i}.org/", p) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == dict.fromkeys(range(4), "own text")


def test_templates_with_articles(spark):
    own = "<body><div>Menu</div><article><div><p>Read our other stories</p></div><p>story {0}{1}</article><div>Side {0}</div>"
    rows = [(i, "http://f.org/", own.format(i, "<p>shared passage</p>" if i < 12 else "")) for i in range(30)]
    rows += [(40 + i, "http://g.org/", f"<body><div>Ticket {i}</div><article>one story</article>") for i in range(9)]
    body = "<body><p>the long text of the page, number {0}, has no mark at all</p>{1}"
    rows += [(60, "http://h.org/", body.format(0, "<article>Teaser</article>")),
             (61, "http://h.org/", body.format(1, "<article class='comment odd'>First! I was here, and I have so much to say on it</article>"))]
    got = {r.page_id: r.text for r in templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert got[i] == f"story {i}{' shared passage' if i < 12 else ''}"
    assert all(got[40 + i] == "one story" for i in range(9))  # nine pages, one article
    assert got[60] == "the long text of the page, number 0, has no mark at all Teaser"
    assert got[61] == "the long text of the page, number 1, has no mark at all"


def test_mix_meets_targets(spark, docs):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(5, 60)), "aa" if i % 4 else "bb", f"s{i % 3 and 1}") for i in range(3000)]
    rows += [(None, None, None, None), (5000, "", "aa", "s0")]
    got = mixing.mix(docs(rows), {"lang": {"aa": 0.5, "bb": 0.5}}, keep=0.4).toPandas()
    assert len(got) == 3002
    kept = got[got.selected]
    share = kept.groupby("lang").tokens.sum() / kept.tokens.sum()
    assert abs(share["aa"] - 0.5) < 0.04 and abs(kept.tokens.sum() / got.tokens.sum() - 0.4) < 0.04
    assert (got.probability <= 1).all()
    assert mixing.selected(docs(rows), {"lang": {"aa": 0.5, "bb": 0.5}}, keep=0.4).count() == len(kept)


def test_pipeline_stages(spark):
    import corpus_pipeline
    frame = corpus_pipeline.table(spark, "/root/testdata/sf0.001", "documents")
    columns, n = frame.columns, frame.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.written(stage(spark, frame, "/root/testdata/sf0.001"), name)
        assert frame.columns == columns and 0 < frame.count() <= n
        n = frame.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, "/root/testdata/sf0.001")
    assert pieces.select("doc_id").distinct().count() == n
