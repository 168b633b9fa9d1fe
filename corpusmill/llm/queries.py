"""Registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import (
    fuzzy_lines, gram_join, html_ttr, importance_resampling, langid_bloom, ogg, queue_bpe, ragged_bpe, semicrf_pii, simhash_pivots, source_divergence, suffix_automaton, url_markov,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.group_near_copies(_table(spark, sf_dir, "documents"))


def op2_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_markov.judge(_table(spark, sf_dir, "pages"))


def op3_langid_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", langid_bloom.held_out("doc_id").alias("held_out"), "text")
    return langid_bloom.identify(marked, langid_bloom.fit(docs), id_cols=["doc_id", "held_out"])


def op4_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.read(ogg.store(_table(spark, sf_dir, "documents")))


def op5_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_automaton.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(_table(spark, sf_dir, "documents"))


def op7_ragged_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ragged_bpe.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_semicrf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return semicrf_pii.find_pii(docs, semicrf_pii.fit(docs))


def op9_html_ttr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_ttr.extract(_table(spark, sf_dir, "pages"))


def op10_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_gram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gram_join.join_grams(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_simhash_pivots, op2_url_markov, op3_langid_bloom, op4_ogg, op5_suffix_automaton, op6_fuzzy_lines, op7_ragged_bpe, op8_semicrf_pii, op9_html_ttr, op10_queue_bpe,
        op11_source_divergence, op12_importance_resampling, op13_gram_join, pipeline,
    )
    return {f.__name__: f for f in own}


#: Words and windows by lists and joins; a window is a string of its words. Runs of hits are counted by position.
OP5_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)
), found AS (SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON g.n = x.n AND g.s = x.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


#: Every kept term in every group, zeros included; shares in whole numbers of 128 bits.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), o AS (SELECT lang, source, id, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(max(s.n), 0) AS n FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (g.n + 5 * v.v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
  SELECT k.lang, k.term, 1 + CAST(1000000000 AS HUGEINT) * (sum(p.n) + 5) // (any_value(t.n) + 5 * any_value(v.v)) AS q
  FROM k JOIN p USING (lang, term) JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS n FROM g GROUP BY 1) t USING (lang) GROUP BY 1, 2
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_suffix_automaton": OP5_SQL, "op11_source_divergence": OP11_SQL}
