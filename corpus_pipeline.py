"""Corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again,
and works on all that its predecessor kept. All but the last return the
columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import catalog, classifier, jaccard, packing, rules, suffixes
from basketry.llm.common import staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the naive-Bayes support vectors score as good; learned from the labels of this input."""
    return classifier.keep_good(docs, classifier.fit(docs, table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the cascade."""
    return rules.keep_passing(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near copies."""
    return jaccard.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that documents with smaller ids hold."""
    return suffixes.without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences."""
    return packing.packing_digest(docs, catalog.tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", best_fit_packing),
]
#: The learned scores of the first stage have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
