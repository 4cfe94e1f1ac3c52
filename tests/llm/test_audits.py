"""Filter audit, line dedup and source divergence against brute force, and odd input."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratus.llm import divergence, filter_audit, line_dedup, seen
from stratus.llm.term_packing import count_terms, radix_order
from stratus.llm.textbytes import mix

WORD = re.compile("[^\x20\x09-\x0d]+")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd_rows(rng):
    """Copies, ties, nulls in each column, empty and long texts, repeated rows and doc_ids."""
    syllables = ["ka", "Lo", "mi", "né", "zu", " ß", "日本", "x.", "#"]
    def text(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(n))
    line = "A line that many documents share, with FORTY characters or more"
    rows = [(i, "\n".join([text(rng.randrange(0, 260)), *([line] * (i % 3)), "  " + line.upper() + "\t" if i % 7 == 0 else "short"]),
             rng.choice(["aa", "bb", None]), rng.choice(["s0", "s0", "s1", "s2", "", None])) for i in range(90)]
    rows += [(100 + i, rows[i % 4][1], "aa", "s1") for i in range(12)]
    rows += [(120 + i, "é" * 39 + str(i % 2), "aa", "s0") for i in range(14)]
    rows += [(200, None, None, None), (201, "", "cc", "only"), (202, " \x0b\n\x1c\n", "aa", "s0"), (None, rows[0][1], "aa", "s0"),
             (None, None, "aa", "s0"), (3, rows[3][1], "bb", "s9"), (3, rows[3][1], "bb", "s9"), (-5, rows[7][1], "aa", "s1"),
             (203, ("long " * 30000) + "W" * 70000 + "\n" + line, "bb", "s2"), (204, "\x00nul\x00 byte", "bb", "s2")]
    return rows


@pytest.fixture
def odd(docs):
    # other columns with the names used inside are ignored
    return lambda rows: docs(rows).withColumns({c: F.lit("clash") for c in ("h", "mask", "part", "key", "keys", "term", "p", "q", "n", "rank")})


def brute_audit(rows, labels):
    first = {}
    for d, t, _, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for d, t, _, source in rows:
        t = t or ""
        w = WORD.findall(t)
        out = {"A"} if len(w) < 200 else set()
        out |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        out |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        out |= {"E"} if d is not None and first.get(t, d) < d else set()
        fails.append((source or "", out, d in good, d in toxic))
    found, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own),
                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def test_filter_audit_against_brute_force(spark, odd):
    rows = odd_rows(random.Random(1))
    labels = [(i, i % 2, i % 3) for i in range(0, 210, 2)] + [(4, 1, None), (None, 1, 1), (6, None, None), (1000, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.interactions(filter_audit.mask_counts(filter_audit.failures(odd(rows)), marks)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == brute_audit(rows, labels)
    assert len(got) == 600 * len({r[3] or "" for r in rows})
    assert filter_audit.interactions(filter_audit.mask_counts(filter_audit.failures(odd([])), marks)).count() == 0
    assert filter_audit.interactions(filter_audit.mask_counts(filter_audit.failures(odd(rows)), marks.limit(0))).count() == len(got)


def test_filter_audit_does_not_trust_the_sketch(spark, odd, monkeypatch):
    """A sketch so full that it clears nothing changes no row."""
    rows = odd_rows(random.Random(2))
    wanted = brute_audit(rows, [])
    monkeypatch.setattr(seen, "possible", lambda plane, hashes, k: np.ones(len(hashes), bool))
    import pyspark.cloudpickle as cp
    cp.register_pickle_by_value(filter_audit)
    cp.register_pickle_by_value(seen)
    try:
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        got = filter_audit.interactions(filter_audit.mask_counts(filter_audit.failures(odd(rows)), labels)).collect()
    finally:
        cp.unregister_pickle_by_value(filter_audit)
        cp.unregister_pickle_by_value(seen)
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == wanted


def test_sketch_never_clears_a_repeat():
    rng = np.random.default_rng(1)
    keys = mix(rng.integers(0, 1 << 62, 5000).astype(np.uint64))
    again = keys[rng.integers(0, 5000, 900)]
    n_places = seen.places_for(5900, 16)
    counts = np.zeros(n_places, np.int64)
    for task in (keys[:2500], keys[2500:], again):
        for batch in seen.parts(iter(np.array_split(task, 7)), n_places, 6):
            for segment, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for part in (once, twice):
                    np.add.at(counts, segment * seen.SEGMENT + np.frombuffer(part, np.uint16).astype(np.int64), 1)
    plane = np.packbits(counts > 1)
    maybe = seen.possible(plane, keys, 6)
    repeated = np.isin(keys, again)
    assert maybe[repeated].all() and maybe[~repeated].mean() < 0.01


def brute_lines(rows, documents, chars):
    def key(line):
        return line.strip(" \t\n\r\x0b\x0c").translate(UPPER)
    holders = defaultdict(set)
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars and d is not None:
                holders[key(line)].add(d)
    found = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(holders.get(key(x), ())) < documents or d == max(holders[key(x)])]
        found.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return Counter(found)


def test_line_dedup_against_brute_force(odd):
    rows = odd_rows(random.Random(3))
    got = Counter(map(tuple, line_dedup.dedup_lines(odd(rows)).collect()))
    assert got == brute_lines(rows, 5, 40) and sum(n * c for (_, _, n, _), c in got.items()) > 100
    assert line_dedup.dedup_lines(odd([])).count() == 0
    assert Counter(map(tuple, line_dedup.dedup_lines(odd(rows[90:]), 2, 10).collect())) == brute_lines(rows[90:], 2, 10)


def test_packed_counts_against_brute_force():
    rng = random.Random(4)
    words = ["a", "Abcdefgh", "abcdefghi", "abcdefghijklmnop", "ABCDEFGHIJKLMNOPq", "é" * 4, "é" * 5, "日" * 11, "x" * 40, "y" * 333, "z" * 5000, "퟿", "\u0080"]
    texts = [rng.choice(["", " ", "-"]).join(rng.choices(words, k=rng.randrange(0, 40))) or None for _ in range(200)]
    group = np.array([rng.randrange(3) for _ in texts])
    n, docs = Counter(), Counter()
    for t, g in zip(texts, group, strict=True):
        own = Counter(x.translate(UPPER) for x in TERM.findall(t or ""))
        for x, c in own.items():
            n[g, x] += c
            docs[g, x] += 1
    got_n, got_docs = Counter(), Counter()
    for gs, terms, ns, ds in count_terms(pa.array(texts), group, 3000):
        keys = list(zip(gs.tolist(), terms.to_pylist(), strict=True))
        assert len(set(keys)) == len(keys)
        for k, a, b in zip(keys, ns.tolist(), ds.tolist(), strict=True):
            got_n[k] += a
            got_docs[k] += b
    assert got_n == n and got_docs == docs


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(5)
    high, low = rng.integers(0, 5, 4000).astype(np.uint64), rng.integers(0, 1 << 63, 40).astype(np.uint64)[rng.integers(0, 40, 4000)]
    assert (radix_order([high, low], np.arange(4000)) == np.lexsort((low, high))).all()


def brute_divergence(rows, least, top):
    rows = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    occurrences, docs = Counter(), Counter()
    for t, lang, source in rows:
        own = Counter(x.translate(UPPER) for x in TERM.findall(t))
        for x, c in own.items():
            occurrences[lang, source, x] += c
            docs[lang, x] += 1
    groups = sorted({(lang, source) for _, lang, source in rows})
    out = set()
    for lang in {g for g, _ in groups}:
        terms = [x for (g, x), d in docs.items() if g == lang and d >= least]
        sources = [s for g, s in groups if g == lang]
        def shares(counts):
            total = sum(counts)
            return [1 + 10**9 * (c + 5) // (total + 5 * len(terms)) for c in counts]
        p = {s: shares([occurrences[lang, s, x] for x in terms]) if terms else [] for s in sources}
        q = shares([sum(occurrences[lang, s, x] for s in sources) for x in terms]) if terms else []
        for s in sources:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o.encode()) for o in sources if o != s]
            out |= {(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(sorted(pairs), 1)}
            own = [(b - a, x.encode()) for x, a, b in zip(terms, p[s], q, strict=True) if occurrences[lang, s, x] and a > b]
            out |= {(lang, s, "term", x.decode(), -v, i) for i, (v, x) in enumerate(sorted(own)[:top], 1)}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_divergence_against_brute_force(odd, monkeypatch, small):
    if small:  # many blocks of terms, sources dealt out too
        for name in ("CELLS", "TERMS", "SUMS"):
            monkeypatch.setattr(divergence, name, 7)
    rows = odd_rows(random.Random(6))
    got = [tuple(r) for r in divergence.divergence(odd(rows), least=3, top=4).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows, 3, 4)
    assert divergence.divergence(odd([])).count() == 0


def test_kept_digest_is_of_the_kept_text(spark):
    from stratus.llm.registry import QUERIES
    got = QUERIES["op12_bloom_lines"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    wanted = brute_lines([(d, t) for d, t in texts.items()], 5, 40)
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == {
        (d, n, x, hashlib.sha256(t.encode()).hexdigest()) for d, n, x, t in wanted}
