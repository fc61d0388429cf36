"""Prepare the documents table for training: five stages, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs`` as they
came, whatever they are called; only ``text``, and ``n_chars`` with it, may change. Null texts, empty
tables, repeated rows and ties are defined by the operators' contracts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from indicora.llm.common import in_fold, stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go. Learned from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(~in_fold("doc_id", 3, 1)).select("doc_id", "toxic")
    return toxicity.accepted(docs, toxicity.trained(docs, labels), 0.7)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document of smaller id holds go. All documents stay, also those left empty."""
    cut = line_dedup.without_repeated_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts alike on five-word shingles (Jaccard 0.8), the smallest id stays."""
    return ngram_join.one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, also slightly changed, go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as sequences of 4096 tokens: one row per piece."""
    return packing.sequences(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: A learned score and a tokenizer can't be said in SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
