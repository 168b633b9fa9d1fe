"""The corpus pipeline: documents in, token digests of what is worth training on out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import batches, fuzzy_lines, gram_join, langid_bloom, queue_bpe, suffix_automaton

#: A document whose best language holds a smaller share of its n-grams is of no known language.
MIN_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from them."""
    return langid_bloom.keep_identified(docs, langid_bloom.fit(docs), MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first occurrence of each line and its near copies; documents that have nothing else go."""
    return fuzzy_lines.keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: like SimHashes, or five-word shingles with a Jaccard similarity of 0.8."""
    return gram_join.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No passages of the benchmark, and no documents that mostly consist of them."""
    return suffix_automaton.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of what is left, by digests of ids and of the decoded text."""
    return queue_bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("bpe", bpe_round_trip)]

#: Learned filters and hashes of words can't be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage returns is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, path = batches.stored(docs)
            if before:
                batches.discard(spark, before)  # nothing reads what came before the last stage
            before = path
    return docs
