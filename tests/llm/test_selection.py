"""Top-k search, fill-in-the-middle and importance resampling against brute force and exact round trips."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from indicora.llm import fill_in_middle, importance_resampling, topk_search
from indicora.llm.fill_in_middle import SkipList, UNITS
from tests.llm.cases import empty, frame, odd, odd_texts, prose, rows
from tools.check_queries import compare

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def text_of(value):
    return value if isinstance(value, str) else ""


# --- top-k search

VECTORS = "vec_id long, embedding array<double>, score string, rank int"


def top_by_hand(items, k=20, scale=64, asks=lambda i: i is not None and i % 20 == 0):
    """items: (id, vector or None). Per query row: [(id, score)], in the order of items."""
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in items if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(whole):
        if asks(i):
            found = [(-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(q, v)))), -(1 << 63) if j is None else j) for m, (j, v) in enumerate(whole) if m != n]
            out.append((i, [(j, -s) for s, j in sorted(found)[:k]]))
    return out


def top_by_spark(spark, items, parts=3, **args):
    df = spark.createDataFrame([(i, v, "mine", 7) for i, v in items], VECTORS).repartition(parts)
    got: dict = {}
    for r in topk_search.top_k(df, F.col("vec_id") % 20 == 0, **args).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-(1 << 63) if r.vec_id is None else r.vec_id, r.score, r["rank"]))
    return got


def test_top_k_of_odd_vectors(spark):
    pick = random.Random(5)
    vector = lambda: [pick.gauss(0, 0.2) for _ in range(8)]
    items = [(i, vector()) for i in range(90)]
    items += [(200, None), (220, [0.1, None]), (240, [float("nan")] * 8), (260, [float("inf"), 1.0]), (280, [0.5]), (300, []), (None, vector()), (None, [9.0] * 8)]
    items += [(400 + i, [1.0] * 8) for i in range(60)]  # ties
    got = top_by_spark(spark, items)
    want = top_by_hand(items)
    assert set(got) == {i for i, _ in want} and {200, 220, 240, 260}.isdisjoint(got)
    for i, best in want:
        assert [(j, s) for j, s, _ in got[i]] == best
        assert [r for *_, r in got[i]] == list(range(1, 21))


def test_top_k_of_few_and_of_repeated_rows(spark):
    items = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [0.5, 0.5])]
    assert {q: [x[:2] for x in v] for q, v in top_by_spark(spark, items).items()} == dict(top_by_hand(items))
    twice = [*items, (0, [1.0, 2.0])]
    got = top_by_spark(spark, twice)[0]
    assert sorted(x[:2] for x in got) == sorted(x for _, best in top_by_hand(twice) for x in best)  # both rows answer
    assert top_by_spark(spark, []) == {} and top_by_spark(spark, [(1, [1.0])]) == {} and top_by_spark(spark, [(20, [1.0])]) == {}


def test_top_k_of_huge_components(spark):
    items = [(20 * i, [(-1) ** i * 3.0e7 * (i + 1), 1.0, 2.0e8 / (i + 1)]) for i in range(12)] + [(1, [1e19, 1e19, 1e19]), (3, [1.7e308, 0.0, 0.0])]
    got = top_by_spark(spark, items)
    for i, best in top_by_hand([(i, [min(max(x, -1e300 / 64), 1e300 / 64) for x in v]) for i, v in items]):
        assert [x[:2] for x in got[i]] == best


def test_top_k_over_many_segments_and_cells(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "ROW_SIZE", 60)
    monkeypatch.setattr(topk_search, "COLUMN_SIZE", 200)
    pick = np.random.default_rng(3)
    items = [(i, v) for i, v in enumerate((pick.normal(size=(400, 6)) * 0.3).tolist())]
    got = top_by_spark(spark, items, parts=12, k=5)
    for i, best in top_by_hand(items, k=5):
        assert [x[:2] for x in got[i]] == best


def test_blocks_are_pruned_and_results_whole():
    pick = np.random.default_rng(1)
    centres = pick.normal(size=(40, 32))
    values = np.floor(64 * (centres[pick.integers(0, 40, 8000)] + 0.1 * pick.normal(size=(8000, 32))))
    values = values[topk_search.near_order(values)]
    table = topk_search.Rows(np.arange(8000), np.arange(8000), values)
    queries = table.at(np.arange(0, 8000, 20))
    best, scored = topk_search.search(queries, table, topk_search.block_ends(8000), 10, np.full(400, topk_search.LEAST))
    assert scored < 0.25 * 400 * 8000
    score = values[::20] @ values.T
    score[np.arange(400), np.arange(0, 8000, 20)] = -1e18
    order = np.lexsort((np.broadcast_to(np.arange(8000), score.shape), -score), axis=1)[:, :10]
    assert best.held[2].reshape(400, 10).tolist() == order.tolist()


# --- fill in the middle


def boundaries(text, unit):
    """Code points before each unit, and before the end."""
    if unit == "code_point":
        return list(range(len(text) + 1))
    blank = " \t\n\v\f\r"
    if unit == "line":
        return [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"] + [len(text)]
    return [i for i in range(len(text)) if i == 0 or text[i] not in blank and text[i - 1] in blank] + [len(text)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "é", "日", "😀", " ", "\n", "\t", "word ", "x\n"]), max_size=300), st.sampled_from(sorted(UNITS)), st.integers(3, 40))
def test_places_in_a_skip_list(parts, unit, width):
    text = "".join(parts)
    before = fill_in_middle.NODE, fill_in_middle.FAN, fill_in_middle.SLICE
    fill_in_middle.NODE, fill_in_middle.FAN, fill_in_middle.SLICE = 2 + width % 5, 2 + width % 3, width
    try:
        index = SkipList(np.frombuffer(text.encode(), np.uint8), UNITS[unit])
        marks = boundaries(text, unit)
        assert (index.units, index.points) == (len(marks) - 1, len(text))
        assert [index.place(r) for r in range(len(marks))] == [(m, len(text[:m].encode())) for m in marks]
    finally:
        fill_in_middle.NODE, fill_in_middle.FAN, fill_in_middle.SLICE = before


def test_a_long_text_is_cut_exactly():
    text = "añ日😀z " * 400_000
    data = np.frombuffer(text.encode(), np.uint8)
    index = SkipList(data)
    assert len(index.lanes) > 3 and sum(len(lane[0]) for lane in index.lanes) < len(text) / 32
    for rank in (0, 1, 63, 64, 1_234_567, len(text) - 1, len(text)):
        points, at = index.place(rank)
        assert (points, at) == (rank, len(text[:rank].encode()))


def middle_by_hand(doc_id, text):
    sha = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(sha[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return ("spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_middles(spark):
    docs = odd(spark).unionByName(frame(spark, ["<P>", "a <S b<", "< M>", "<M> x", "tail <"] + [f"<{prose(k, 3)}<S" for k in range(40)], range(500, 545)), allowMissingColumns=True)
    docs = docs.withColumns({"form": F.lit("mine"), "n": F.lit("x"), "output": F.lit(1)})
    made = fill_in_middle.transformed(docs).withColumn("back", fill_in_middle.restored())
    assert {"lang", "source", "kept"} <= set(made.columns) and "text" not in made.columns
    got = sorted((r.doc_id if r.doc_id == r.doc_id else -1, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect() if r.doc_id is not None)
    want = sorted((r.doc_id, len(text_of(r.text)), *middle_by_hand(r.doc_id, text_of(r.text)), text_of(r.text)) for r in docs.collect() if r.doc_id is not None)
    assert [tuple(map(str, g)) for g in got] == [tuple(map(str, w)) for w in want]
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    null = [r for r in made.collect() if r.doc_id is None]
    assert len(null) == 1 and null[0].back == prose(9, 70)


@pytest.mark.parametrize("unit", ["word", "line"])
def test_middles_of_words_and_lines(spark, unit):
    docs = frame(spark)
    for r in fill_in_middle.transformed(docs, unit=unit).withColumn("back", fill_in_middle.restored()).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = text_of(r.text)
        marks = boundaries(text, unit)
        assert r.back == text and r.n == len(marks) - 1
        if r.form != "plain":
            assert (r.prefix_chars, r.prefix_chars + r.middle_chars) == (marks[r.prefix_units], marks[r.prefix_units + r.middle_units])


def test_middles_of_nothing(spark):
    assert fill_in_middle.transformed(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle.transformed(empty(spark), sentinels=("<P>", "<S<", "<M>"))


# --- importance resampling


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abZ09 é日_-\n", max_size=120), max_size=6))
def test_features(texts):
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    bucket, doc, n_words = importance_resampling.features(data, offsets, 997, 2)
    for t, text in enumerate(texts):
        words = WORD.findall(text.translate(LOW))
        want = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        assert sorted(bucket[doc == t].tolist()) == sorted(zlib.crc32(w.encode()) % 997 for w in want)
        assert n_words[t] == len(words)


def drawn_by_hand(docs, target):
    runs = lambda t: (w := WORD.findall(text_of(t).translate(LOW))) + [f"{a} {b}" for a, b in zip(w, w[1:])]
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for texts, into in (([x for _, x in docs], s), (target, t)):
        for x in texts:
            for f in runs(x):
                into[bucket(f)] += 1
    total, wanted = sum(s), sum(t)
    out = []
    for doc, x in docs:
        found = runs(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total + 10000) / ((s[b] + 1) * (wanted + 10000)))) for b in map(bucket, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(WORD.findall(text_of(x))) >= 20])
    able = sorted((-r[3], -(1 << 63) if r[0] is None else r[0], n) for n, r in enumerate(out) if r[4])
    ranks = {n: k + 1 for k, (*_, n) in enumerate(able[: 25 * len(able) // 100])}
    return [(*r[:4], ranks.get(n)) for n, r in enumerate(out)]


def test_draws(spark):
    texts = odd_texts() + [prose(k, 10 + k) for k in range(60)] + ["w" * 200_000 + " tail " + "é" * 70]
    docs = frame(spark, [*texts, prose(3, 30), prose(8, 30)], [*range(len(texts)), 3, None]).withColumns({"score": F.lit("x"), "rank": F.lit(2), "weight": F.lit(1)})
    target = frame(spark, [prose(k, 25) for k in range(100, 120)] + [None])
    got = importance_resampling.resampled(docs, target)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    want = drawn_by_hand(pairs, [r.text for r in target.collect()])
    rank_free = lambda r: tuple(map(str, r))
    assert sorted(rank_free((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in got.collect()) == sorted(map(rank_free, want))
    chosen = importance_resampling.selected(docs, got)
    assert sorted(r["rank"] for r in chosen.collect()) == sorted(r[4] for r in want if r[4] and r[0] is not None)


@pytest.mark.parametrize("chunk_bits, digit_bits", [(3, 2), (20, 16), (2, 5)])
def test_radix_sort(spark, chunk_bits, digit_bits):
    pick = random.Random(chunk_bits)
    data = [(pick.choice([None, -5, 0, 7, 7, 7, 1 << 40, -(1 << 63), (1 << 63) - 1]), pick.randrange(-30, 30), k) for k in range(300)]
    df = spark.createDataFrame(data, "a long, b long, k long").repartition(5)
    ranked = importance_resampling.radix_ranked(df, [("a", True), ("b", False)], chunk_bits=chunk_bits, digit_bits=digit_bits).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 301)) and {r.k for r in ranked} == set(range(300))
    low = lambda v: -(1 << 63) if v is None else v
    assert [(low(r.a), r.b) for r in sorted(ranked, key=lambda r: r["rank"])] == sorted(((low(a), b) for a, b, _ in data), key=lambda x: (-x[0], x[1]))


def test_draws_from_little(spark):
    assert importance_resampling.resampled(empty(spark), empty(spark)).count() == 0
    few = importance_resampling.resampled(frame(spark, [prose(1, 30)] * 4 + [None]), empty(spark)).collect()
    assert len(few) == 5 and [r["rank"] for r in few if r["rank"]] == [1]


@pytest.mark.parametrize("name", ["op11_topk_search", "op12_fill_in_middle", "op13_importance_resampling"])
def test_answers(spark, tiny, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    assert compare(rows(entry.queries()[name](spark, tiny)), db.execute(entry.oracle_sql()[name]).df()) == ""
