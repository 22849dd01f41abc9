"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    classifier,
    clusters,
    divergence,
    jaccard,
    licenses,
    packing,
    personal,
    rules,
    sharding,
    suffixes,
    token_files,
    unigram,
    vectors,
)
from .common import table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_digest(table(spark, sf_dir, "documents"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_query(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classifier.scores(docs, classifier.fit(docs, labels))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked_vectors(table(spark, sf_dir, "embeddings"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_digest(table(spark, sf_dir, "documents")).drop("failed_rule")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.segmentation_digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.centroid_clusters(table(spark, sf_dir, "embeddings"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in found}


#: Words, symbols, lines and repeats by DuckDB; the cascade's verdict as one OR.
RULES_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM base WHERE len(w) >= 8),
win AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS s FROM starts),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n >= 2),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM
  (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
m AS (SELECT b.doc_id, len(w) AS n_words,
         len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM base b LEFT JOIN covered c USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM m
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scans": licenses.licence_sql(), "op9_quality_rules": RULES_SQL,
            "op11_centroid_clusters": clusters.CLUSTERS_SQL,
            "op13_source_divergence": divergence.DIVERGENCE_SQL}
