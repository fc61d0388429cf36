"""Tokens against the tokenizer, packing against its bounds and an exact round trip."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from indicora.llm import packing
from tests.llm.cases import empty, odd, odd_texts, rows

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def by_tokenizer(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), st.sampled_from("'sStTdDlLrReE \n\t’éÉßÑ1²½ªºİıŉǅΣ"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_of_any_text(text):
    assert packing.token_ids([text], PATH) == [by_tokenizer(text)]


def test_ids_of_every_latin_character():
    """Alone, inside a word, doubled, and after an apostrophe, a digit and a sign."""
    for code in range(1, 0x260):
        c = chr(code)
        texts = [c, f"ab{c}cd", f"{c}{c}", f"x {c}y'{c} 1{c}2 .{c}!", f"'{c}s'll{c}"]
        assert packing.token_ids(texts, PATH) == [by_tokenizer(t) for t in texts], hex(code)


def test_ids_of_long_words():
    texts = ["a" * 3000 + " b", "é" * 200, "'" * 300, "1" * 500, "x'" * 400]
    assert packing.token_ids(texts, PATH) == [by_tokenizer(t) for t in texts]


MARKERS = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "<|", "|>", "endoftext"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*MARKERS, " ", "a", "B", "é", "1", "'s", "\n"]), max_size=12))
def test_ids_of_texts_with_added_tokens(parts):
    assert packing.token_ids(["".join(parts)], PATH) == [by_tokenizer("".join(parts))]


def test_added_tokens_are_one_id():
    assert packing.token_ids(["a <|endoftext|> b", "<|startoftext|>"], PATH) == [np.array(i, "<u4").tobytes() for i in ([320, 49407, 321, 1], [49406, 1])]


def test_ids_with_a_small_memory(monkeypatch):
    monkeypatch.setattr(packing.WordIds, "limit", 50)
    assert packing.token_ids(odd_texts(), PATH, group=500) == [by_tokenizer(t) for t in odd_texts()]
    packing.word_ids.cache_clear()


def check(got, capacity, want):
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.length <= capacity).all() and (got.length > 0).all()
    for _, own in got.groupby("sequence_id"):
        assert own.offset.tolist() == np.r_[0, np.cumsum(own.length)[:-1]].tolist() and own.length.sum() <= capacity
    pieces = got.fillna({"doc_id": -1})
    assert sorted(zip(pieces.doc_id, pieces.piece, pieces.start, pieces.length, pieces.ids_crc32)) == sorted(want)
    total = got.length.sum()
    assert got.sequence_id.nunique() <= max(np.ceil(total / capacity) * 1.15 + 1, (got.length > capacity / 2).sum() + 1)


def wanted(docs, capacity):
    out = []
    for i, text in zip(docs.doc_id.fillna(-1), docs.text):
        ids = by_tokenizer(text if isinstance(text, str) else "")
        out += [(i, k, a // 4, len(ids[a : a + 4 * capacity]) // 4, zlib.crc32(ids[a : a + 4 * capacity])) for k, a in enumerate(range(0, len(ids), 4 * capacity))]
    return out


@pytest.mark.parametrize("capacity", [64, 4096])
def test_round_trip(spark, capacity):
    docs = odd(spark)
    check(rows(packing.sequences(docs, PATH, capacity)), capacity, wanted(rows(docs), capacity))


def test_query_packs_whole_table(spark, tiny):
    docs = rows(spark.read.parquet(f"{tiny}/documents.parquet"))
    got = rows(entry.queries()["op2_best_fit_packing"](spark, tiny))
    check(got, 4096, wanted(docs, 4096))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_best_fit(lengths):
    bins = packing.best_fit(np.array(lengths, np.int64), 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    fill = [sum(lengths[i] for i in b) for b in bins]
    assert all(f <= 100 for f in fill) and len(bins) <= np.ceil(sum(lengths) / 100) * 1.7 + 1
    assert sum(f <= 50 for f in fill) <= 1


def test_rounds_join_underfull_bins(spark):
    parts = spark.range(3000).repartition(12).selectExpr("id as doc_id", "0 as piece", "0L as start", "cast(20 + id * 7 % 40 as long) as length", "id as ids_crc32")
    total = parts.agg({"length": "sum"}).first()[0]
    for items in (100, 200_000):  # many tasks to the end, and one at last
        packed = packing.bins(parts, 100, items_per_task=items)
        got = rows(packed.selectExpr("filled", "size(doc_ids) as n"))
        assert got.filled.sum() == total and got.n.sum() == 3000 and got.filled.max() <= 100
        assert len(got) <= total / 100 * 1.05 + 12
    halves = parts.selectExpr("doc_id", "piece", "start", "60L as length", "ids_crc32")
    assert packing.bins(halves, 100, items_per_task=500).count() == 3000


def test_empty(spark):
    assert packing.sequences(empty(spark), PATH).count() == 0
