"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlab.llm import chat, fingerprints, language, lines, mixing, negatives, neighbours, ngram_join, packing, prefix_trie, quality, secret_scan, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "lines_removed", "words_removed")


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.classes(table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL["op4_ngram_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), tokens AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM pairs WHERE 100 * shared >= 90 * (na + nb - shared)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON reached.other = both_ways.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""


@query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    records = chat.records_of_rows(rows.unionByName(added))
    read = chat.read_back(chat.format_records(records, "record", ["conv_id"]))
    turns = F.array_join(F.transform("turns_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns_read").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# Control strings inside roles and texts get one character more.
_ESCAPED = r"length(regexp_replace({0}, '([<\[])(\\*)(\|[a-z_]+\|>|/?s>|/?INST\])', '\1\\\2\3', 'g'))"
SQL["op5_chat_formatting"] = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len("<|turn|><|text|><|end|>") + 1} + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.score(docs, labels, learn=~held_out).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = language.predict(table(spark, sf_dir, "documents"), learn=~F.coalesce(held_out, F.lit(False)))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id = F.col("conv_id")
    turns, lengths = prefix_trie.with_heads(
        prefix_trie.turns_of(table(spark, sf_dir, "conversations")),
        base=conv_id - conv_id % 20,
        head=F.crc32(conv_id.cast("string")) % 4,
        most=3,
    )
    return prefix_trie.trie(turns, lengths)


# CRC-32 of the decimal digits, bit by bit, and the shorter form of a turn that orders equal turns too.
_CRC = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
  lambda a, b: list_reduce(CAST(range(8) AS BIGINT[]),
    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(a, b)), 4294967295), 4294967295)"""
_TURN = "substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)"
SQL["op11_conversation_prefix_trie"] = rf"""
WITH told AS (
  SELECT conv_id, turn, {_TURN} AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS MATERIALIZED (
  SELECT conv_id, list({{'g': digest, 'w': words}} ORDER BY turn NULLS FIRST, digest) AS t FROM told GROUP BY conv_id
), heads AS MATERIALIZED (
  SELECT conv_id, t, conv_id - conv_id % 20 AS base, CAST({_CRC} % 4 AS BIGINT) AS h FROM own
), rebuilt AS MATERIALIZED (
  SELECT a.conv_id, list_concat(coalesce(b.t, [])[1:h], a.t[h + 1:]) AS t FROM heads a LEFT JOIN own b ON a.base = b.conv_id
), members AS MATERIALIZED (
  SELECT conv_id, d, array_to_string(list_transform(t[1:d], lambda x: x.g), '') AS k, t[d].w AS words, d = len(t) AS ends
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS MATERIALIZED (
  SELECT d, k, substr(k, 1, length(k) - 32) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM members GROUP BY d, k
), counted AS MATERIALIZED (
  SELECT nodes.*, coalesce(c.n, 0) AS n_children FROM nodes
  LEFT JOIN (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL) c USING (d, k)
), below AS (
  SELECT k, unnest(range(0, d + 1)) AS d, CAST(n_children = 0 AS BIGINT) AS leaf,
    CASE WHEN d > 0 THEN (n_convs - 1) * words ELSE 0 END AS saved FROM counted
), sums AS (
  SELECT d, substr(k, 1, 32 * d) AS k, sum(leaf) AS n_leaves, sum(saved) AS saved FROM below GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN sums USING (d, k) LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.up
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


SQL["op12_hard_negatives"] = """
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS MATERIALIZED (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, 1 + least(len(a.v), len(b.v))), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT r, anchor_id, other AS place, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.r, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.r = s.r AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.ADDED)
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
