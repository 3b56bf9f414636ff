"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placetally.llm import (
    decontamination,
    embedding_dedup,
    html_text,
    importance,
    language_id,
    licenses,
    merkle,
    mixing,
    piece_encoding,
    simhash,
    sql_checks,
    substring_dedup,
    token_counts,
    toxicity,
)
from placetally.llm.common import table

OP1_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), u AS MATERIALIZED (
  SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), p AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (SELECT vec_id, vec_id AS root FROM u UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS root FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.root, v.vec_id) AS component_id,
  v.vec_id = coalesce(c.root, v.vec_id) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN c ON c.vec_id = v.vec_id
"""


OP5_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), b AS MATERIALIZED (
  SELECT item_id::VARCHAR AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark WHERE item_id IS NOT NULL
), w AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS path
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)
), s AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS path
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w))
), m AS MATERIALIZED (SELECT s.doc_id, s.i, s.n, w.item_id FROM s JOIN w ON s.path = w.path AND s.n = w.n),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


OP9_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words
  FROM documents
), w AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS path
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)
), f AS (SELECT path, min(doc_id) AS least FROM w GROUP BY path),
h AS (
  SELECT DISTINCT doc_id, place FROM (
    SELECT w.doc_id, unnest(range(w.i, w.i + 13)) AS place FROM w JOIN f USING (path) WHERE w.doc_id > f.least)
), p AS (SELECT doc_id, words[i] AS word, i FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
k AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n
  FROM p LEFT JOIN h ON p.doc_id = h.doc_id AND p.i = h.place WHERE h.place IS NULL GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, (len(d.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_on(docs, table(spark, sf_dir, "labels")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("bits").alias("fingerprint"), "component_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.read_vocabulary(token_counts.VOCABULARY)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, html_text.fit_on(pages))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit_on(docs))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("licences", ",").alias("licences")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.lower_cased_fifth())


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # the place of the vocabulary files; only this query needs it

    model = piece_encoding.read_model(public_tokenizers.path(piece_encoding.MODEL))
    return piece_encoding.piece_digest(table(spark, sf_dir, "documents"), model)


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_html_text": op7_html_text,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_licenses": op10_licenses,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_piece_encoding": op13_piece_encoding,
}
ORACLES: dict[str, str] = {
    "op1_embedding_dedup": OP1_SQL,
    "op5_decontamination": OP5_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op11_merkle_manifest": sql_checks.OP11,
    "op12_importance_resampling": sql_checks.OP12,
}
