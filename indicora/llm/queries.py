"""The numbered queries: each applies its operator to whole tables and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.llm import (
    decontamination, exact_dedup, fill_in_middle, importance_resampling, language_model, license_scan, line_dedup,
    ngram_join, packing, secret_scan, substring_dedup, topk_search, toxicity,
)
from indicora.llm.common import in_fold, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[make.__name__] = make
    return make


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.sequences(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = line_dedup.without_repeated_lines(docs)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.equal_texts(table(spark, folder, "documents")).drop("n_chunks")


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = substring_dedup.without_repeated_passages(docs)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~in_fold("doc_id", 3, 1)).select("doc_id", "toxic")
    scores = toxicity.scored(docs, toxicity.trained(docs, labels), 0.7)
    return scores.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.scanned(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scanned(docs, secret_scan.trained(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.joined(table(spark, folder, "documents"))


@query
def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return language_model.scored(docs, in_fold("doc_id", 7, 2))


@query
def op11_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle.transformed(table(spark, folder, "documents").select("doc_id", "text"))
    shas = F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *shas)


@query
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance_resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
