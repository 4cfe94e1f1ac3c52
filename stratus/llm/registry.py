"""Registered queries of this subpackage: name -> callable(spark, sf_dir), and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import (
    block_ann, block_topk, chat, divergence, filter_audit, langid, line_dedup, linkgraph, mixing, neardup, packing, quality,
    templates,
)
from stratus.llm.tables import held_out, table

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_prefix_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    given = table(spark, sf_dir, "conversations").select(*columns)
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.read_back(chat.format_conversations(given.unionByName(control)))


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(text)
    + (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '<turn>', ''))) // 6
    + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + length(role)
    + (length(role) - length(replace(role, '\', '')))
    + (length(role) - length(replace(role, chr(10), '')))
    + (length(role) - length(replace(role, '<turn>', ''))) // 6
    + (length(role) - length(replace(role, '</turn>', ''))) // 7
    + 14 AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""



def op2_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=2)


def op6_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id", quality.FOLDS, quality.HELD_FOLD).alias("held_out"), "score", "predicted")


def op8_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return predicted.select("doc_id", held_out("doc_id", langid.FOLDS, langid.HELD_FOLD).alias("held_out"),
                            "lang_pred", "score", "rejected")


# verdict, host, path
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op4_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


# production targets: languages as given, sources and topics flattened
LANGUAGE_SHARES = {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.15}


def op10_proportional_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), {"lang": LANGUAGE_SHARES})


EVERY_50TH = "pmod(vec_id, 50) = 0"


def op5_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_k(table(spark, sf_dir, "embeddings"), EVERY_50TH, k=5)


def op7_block_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_ann.nearest(table(spark, sf_dir, "embeddings"), EVERY_50TH, k=5)


_FINITE = """
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)"""

OP5_SQL = f"""
WITH f AS ({_FINITE}), e AS (SELECT vec_id, list_transform(v, lambda x: floor(256 * x)) AS w FROM f),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.w, d.w) AS BIGINT) AS score
      FROM e q JOIN e d ON q.vec_id <> d.vec_id AND len(q.w) = len(d.w) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP7_SQL = f"""
WITH f AS ({_FINITE}), e AS (SELECT * FROM f WHERE list_dot_product(v, v) > 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id,
        list_dot_product(q.v, d.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(d.v, d.v))) AS score
      FROM e q JOIN e d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

def op11_bloom_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.interactions(filter_audit.mask_counts(flags, table(spark, sf_dir, "labels")))


def op12_bloom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), documents=5, chars=40)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_packed_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), least=30, top=50)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
r AS (SELECT *, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN r.doc_id > first THEN 16 ELSE 0 END) AS mask
  FROM r LEFT JOIN l ON r.doc_id = l.doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS gone
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
t AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (gone | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & gone = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & gone > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & gone = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & gone = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM s, m GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM t
"""

OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(k.doc_id <> c.keeper, false) AS lost FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""

OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{UPPER}', '{LOWER}') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
g AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(v.v, 0) AS v, coalesce(v.lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN (SELECT lang, count(*) AS v, sum(n_lang) AS lang_total FROM k GROUP BY lang) v ON g.lang = v.lang),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n_lang + 5)) // (g.lang_total + 5 * g.v) AS q
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM z
WHERE part = 'pair' OR rank <= 50
"""

QUERIES = {"op1_prefix_target": op1_prefix_target, "op2_superminhash": op2_superminhash,
           "op3_karmarkar_karp": op3_karmarkar_karp, "op5_block_topk": op5_block_topk, "op7_block_ann": op7_block_ann,
           "op6_subword_quality": op6_subword_quality, "op8_subword_langid": op8_subword_langid,
           "op4_link_graph": op4_link_graph, "op9_site_templates": op9_site_templates,
           "op10_proportional_mix": op10_proportional_mix, "op11_bloom_audit": op11_bloom_audit,
           "op12_bloom_lines": op12_bloom_lines, "op13_packed_divergence": op13_packed_divergence}
ORACLES = {"op1_prefix_target": OP1_SQL, "op5_block_topk": OP5_SQL, "op7_block_ann": OP7_SQL,
           "op11_bloom_audit": OP11_SQL, "op12_bloom_lines": OP12_SQL, "op13_packed_divergence": OP13_SQL}
