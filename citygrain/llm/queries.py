"""One registered query for each operator, over its whole table, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.llm import bpe, chat, decontaminate, langid, licenses, lm, passages, ranked, repair, simhash, suffix_dedup, topk, toxicity
from citygrain.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = list(licenses.PHRASES)
    at = F.flatten(F.transform("matches", lambda m: m["places"]))
    return found.withColumn("places", at).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        licenses.labels("matches", base).alias("base_labels"),
        licenses.labels("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"),
    )


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), VOCABULARY, with_ids=False)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest id among its near-duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document, learned from the labels of the training fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, with one that speaks in control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    turns = turns.unionByName(spark.createDataFrame(more, turns.schema))
    return chat.digests(chat.format_chat(turns))


SQL["op5_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, len(text) + len(regexp_extract_all(text,
      '<\\*<SYS>>|<\\*</SYS>>|\[\\*INST\]|\[\\*/INST\]|<\\*s>|<\\*/s>|\[\\*ROLE\]|\[\\*TEXT\]|\[\\*/ROLE\]'))
    + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE len(role) + 23 END AS size,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prior,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE NOT (CASE WHEN prior IS NULL THEN role IN ('system', 'user') WHEN prior = 'system' THEN role = 'user'
    WHEN prior = 'user' THEN role = 'assistant' WHEN prior = 'assistant' THEN role = 'user' ELSE false END
    AND (NOT last OR role = 'assistant'))) AS n_invalid
FROM e GROUP BY conv_id
"""


@query
def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the fuzzy passages it shares with others."""
    return passages.shared_documents(table(spark, sf_dir, "documents"))


@query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op7_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and attention scores of every document."""
    return lm.score_texts(table(spark, sf_dir, "documents"))


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its byte strings that stand more than once, and its passages of 50 words that do."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), passages=suffix_dedup.LONG_WORDS)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_passages",
    )


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside verbatim passages of the benchmark."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


SQL["op10_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM m)) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@query
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the training fold."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs, ~langid.held_out())).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


@query
def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    return ranked.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_ranked"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
dt AS (
  SELECT r, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, count(*) AS tf
  FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY 1, 2),
totals AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM dt GROUP BY t), totals),
b AS (
  SELECT item_id, row_number() OVER () AS q,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
bt AS (
  SELECT q, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, count(*) AS k
  FROM (SELECT q, unnest(w) AS t FROM b) GROUP BY 1, 2),
m AS (SELECT r, doc_id, 25 + 75 * len(w) * n // l AS m FROM d, totals WHERE len(w) > 0),
scores AS (
  SELECT q, m.r, any_value(doc_id) AS doc_id,
    CAST(sum(k * weights.w * (1000000000 * tf // (1000 * tf + 8 * m.m))) AS BIGINT) AS score
  FROM bt JOIN dt USING (t) JOIN weights USING (t) JOIN m ON m.r = dt.r GROUP BY q, m.r),
ranks AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks JOIN b USING (q) WHERE rank <= 10
"""


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation with its faults and the cheapest edits that bring it back into order."""
    turns = table(spark, sf_dir, "conversations")
    return repair.repair_report(repair.damage(turns), turns)


# the labels of states start, system, user and assistant are costs of six digits with the audit behind them
_PAID = "lpad(CAST(CAST(left({l}, 6) AS INTEGER) + {w} AS VARCHAR), 6, '0') || substr({l}, 7) || '{e}'"


def _after(label: str, cost: str, edit: str) -> str:
    return _PAID.format(l=label, w=cost, e=edit)


SQL["op13_repair"] = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
remainders AS (
  SELECT k, xor(list_reduce(list_transform(range(1, len(k) + 1), lambda i: CAST(unicode(substr(k, i, 1)) AS BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
      lambda x, i: xor(x >> 1, (x & 1) * CAST(3988292384 AS BIGINT))), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS d
  FROM (SELECT DISTINCT k FROM keyed)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN d = 3 THEN [0, 0] ELSE [0] END) AS c
  FROM keyed JOIN remainders USING (k) WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
seen AS (
  SELECT *, right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) AS mark,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
faulty AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS k, pair,
    CASE WHEN mark = '' THEN 1 WHEN again THEN 2 WHEN mark NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM seen),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
lattice(conv_id, i, a, b, u, v) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000', CAST(NULL AS VARCHAR), '000002I', '000004II' FROM sums
  UNION ALL
  SELECT conv_id, i, a, b, u, least(v, {_after("u", "2", "I")}) FROM (
    SELECT conv_id, i, a, b, v, least(u, {_after("a", "2", "I")}, {_after("b", "2", "I")}, {_after("v", "2", "I")}) AS u FROM (
      SELECT l.conv_id, r.i,
        {_after("l.a", "3", "D")} AS a,
        least({_after("l.b", "3", "D")}, CASE WHEN may AND k = 's' THEN {_after("l.a", "cut", "K")} END) AS b,
        least({_after("l.u", "3", "D")},
          CASE WHEN may THEN {_after("least(l.a, l.b, l.v)", "cut + 2", "R")} END,
          CASE WHEN may AND k = 'u' THEN {_after("least(l.a, l.b, l.v)", "cut", "K")} END) AS u,
        least({_after("l.v", "3", "D")},
          CASE WHEN may THEN {_after("l.u", "cut + 2", "R")} END,
          CASE WHEN may AND k = 'a' THEN {_after("l.u", "cut", "K")} END) AS v
      FROM lattice l JOIN (SELECT *, fault NOT IN (1, 2) AS may, CAST(fault = 3 AS INTEGER) AS cut FROM faulty) r
        ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i + 1))),
final AS (
  SELECT s.conv_id, least(a, v) AS label FROM lattice l JOIN sums s ON s.conv_id IS NOT DISTINCT FROM l.conv_id AND s.n = l.i),
audits AS (SELECT conv_id, CAST(left(label, 6) AS BIGINT) AS cost, substr(label, 7) AS audit FROM final),
letters AS (
  SELECT conv_id, p, substr(audit, p, 1) AS e, len(replace(left(audit, p), 'I', '')) AS i
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS p FROM audits)),
left_over AS (
  SELECT t.conv_id, p, e, r.role, CASE WHEN e = 'I' THEN '' ELSE r.text END AS text,
    row_number() OVER (PARTITION BY t.conv_id ORDER BY p) AS j,
    first_value(e = 'K' AND r.k = 's') OVER (PARTITION BY t.conv_id ORDER BY p) AS system
  FROM letters t LEFT JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i WHERE e <> 'D'),
said AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (j - CAST(system AS INTEGER)) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS digest FROM left_over GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN said d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""
