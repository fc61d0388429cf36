"""The pipeline's stages against brute force over what the stage before kept."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry
from indicora.llm import decontamination, toxicity
from tests.llm.cases import empty, odd, rows
from tests.llm.test_dedup import documents, lines_by_hand, near_by_hand
from tests.llm.test_packing import check, wanted

NAMES = ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing"]


def followed(spark, docs, folder):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], folder).cache())
    return out


def compare_stages(spark, docs, folder):
    start, kept, cut, alone, clean, packed = followed(spark, docs, folder)
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for stage in (kept, cut, alone, clean):
        assert stage.columns == docs.columns
    assert kept.exceptAll(start).count() == 0
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert start.count() - kept.count() <= 0.2 * max(50, labels.count())
    by_hand = lines_by_hand(documents(kept))
    assert sorted(documents(cut)) == sorted((i, t) for i, t, _, _ in by_hand)
    near = near_by_hand(documents(cut), 0.8)
    assert sorted(i for i, _ in documents(alone)) == sorted(n[0] for n in near if n[5])
    held = {r.doc_id for r in decontamination.matches(alone, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert sorted(i for i, _ in documents(clean)) == sorted(i for i, _ in documents(alone) if i not in held)
    check(rows(packed), 4096, wanted(rows(clean), 4096))
    return kept


def test_stages_on_the_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    kept = compare_stages(spark, docs, tiny)
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    clean = docs.join(labels.where("toxic = 0"), "doc_id", "left_semi")
    lost = clean.join(kept, "doc_id", "left_anti").count()
    assert lost <= 0.02 * clean.count()


def test_stages_on_odd_rows(spark, tiny):
    compare_stages(spark, odd(spark), tiny)


def test_stages_on_an_empty_table(spark, tiny):
    for frame in followed(spark, empty(spark), tiny)[1:]:
        assert frame.count() == 0


def test_run_is_registered(spark, tiny):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    got = corpus_pipeline.run(spark, tiny)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert public_tokenizers.path("word_bpe_49k.json") and toxicity.PLACE_BITS == 18
