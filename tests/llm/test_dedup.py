"""Line, exact, substring and near-duplicate removal against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from indicora.llm import exact_dedup, line_dedup, ngram_join, substring_dedup
from indicora.llm.textbytes import BLANK, NOT_WORD, buffers, word_spans
from tests.llm.cases import empty, frame, odd, odd_texts, prose, rows
from tools.check_queries import compare

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"
NONE = -(1 << 63)


def listed(df, *columns):
    return sorted(map(tuple, rows(df)[list(columns)].itertuples(index=False)), key=repr)


def documents(df):
    got = rows(df)
    return [(NONE if i != i or i is None else int(i), t if isinstance(t, str) else "") for i, t in zip(got.doc_id, got.text)]


@pytest.mark.parametrize("apart, pattern", [(BLANK, r"[^\x20\x09-\x0D]+"), (NOT_WORD, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")])
def test_words(apart, pattern):
    texts = odd_texts()
    data, offsets = buffers(pa.array(texts))
    start, end, doc = word_spans(data, offsets, apart)
    got = [[] for _ in texts]
    for a, b, t in zip(start, end, doc):
        got[t].append(bytes(data[a:b]).decode())
    assert got == [re.findall(pattern, t or "") for t in texts]


def lines_by_hand(docs):
    key = lambda line: line.strip(SPACE).translate(LOW)
    held = defaultdict(set)
    for i, t in docs:
        for line in t.split("\n"):
            held[key(line)].add(i)
    out = []
    for i, t in docs:
        kept = [x for x in t.split("\n") if len(key(x)) < 10 or min(held[key(x)]) == i]
        out.append((i, "\n".join(kept), len(t.split("\n")), len(t.split("\n")) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("twice_bytes", [8, 32 << 20])  # a full filter only suspects more
def test_lines(spark, twice_bytes):
    docs = odd(spark)
    cut = line_dedup.without_repeated_lines(docs, twice_bytes=twice_bytes).fillna(NONE, ["doc_id"])
    assert listed(cut, "doc_id", "text", "n_lines", "n_dropped") == lines_by_hand(documents(docs))
    assert set(docs.columns) | {"n_dropped"} == set(cut.columns)


def test_lines_of_several_texts_under_one_id(spark):
    texts = ["shared line of text", "shared line of text\nunique line a", "unique line b\nshared line of text", "unique line b\nfurther", None, "only further\nunique line a"]
    docs = frame(spark, texts, [1, 2, 2, 3, 2, None])
    cut = line_dedup.without_repeated_lines(docs).fillna(NONE, ["doc_id"])
    assert listed(cut, "doc_id", "text", "n_lines", "n_dropped") == lines_by_hand(documents(docs))
    assert {(2, "unique line b"), (3, "further"), (2, "")} <= {(r.doc_id, r.text) for r in cut.collect()}


def test_lines_of_a_hot_source(spark):
    texts = ["common header line\n" + (prose(k, 8) if k % 3 else "second common line") for k in range(400)]
    docs = frame(spark, texts)
    assert listed(line_dedup.without_repeated_lines(docs), "doc_id", "text", "n_lines", "n_dropped") == lines_by_hand(documents(docs))


def test_exact(spark):
    docs = odd(spark)
    groups = defaultdict(list)
    for i, t in documents(docs):
        groups[t.translate(LOW)].append(i)
    want = sorted(
        ((i, max(groups[k]), len(groups[k]), i == max(groups[k]), hashlib.sha256(k.encode()).hexdigest()) for i, k in ((i, t.translate(LOW)) for i, t in documents(docs))),
        key=repr,
    )
    for widths in ((8, 16, 32), (1, 2, 32)):  # one byte cannot tell chunks apart and is widened
        got = exact_dedup.equal_texts(docs, widths).fillna(NONE, ["doc_id", "keep_id"])
        assert listed(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    with pytest.raises(ValueError):
        exact_dedup.equal_texts(docs, (1,))


def test_chunks_follow_content():
    tail = np.frombuffer(prose(7, 9000).encode(), np.uint8)
    cuts = []
    for head in (b"", b"some words in front "):
        data = np.r_[np.frombuffer(head, np.uint8), tail]
        (ends,) = exact_dedup.chunk_ends(data, np.array([0, len(data)]))
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(data) and sizes.max() <= exact_dedup.MOST and sizes[:-1].min() >= exact_dedup.LEAST
        cuts.append({e - len(head) for e in ends})
    assert len(cuts[0] & cuts[1]) > 0.9 * len(cuts[0])
    flat = np.zeros(200_000, np.uint8)
    assert max(np.diff([0, *exact_dedup.chunk_ends(flat, np.array([0, len(flat)]))[0]])) <= exact_dedup.MOST


def passages_by_hand(docs, width):
    first, words = {}, {i: t.encode().split() for i, t in docs}
    for i in sorted(words):
        for k in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][k : k + width]), (i, k))
    out = []
    for i, t in docs:
        gone = set()
        for k in range(len(words[i]) - width + 1):
            if first[tuple(words[i][k : k + width])] != (i, k):
                gone |= set(range(k, k + width))
        kept = [w for k, w in enumerate(words[i]) if k not in gone]
        out.append((i, b" ".join(kept).decode(), len(words[i]), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_passages(spark, most):
    shared = prose(50, 55)
    texts = odd_texts() + [f"{prose(k, 15)} {shared} {prose(k + 100, 15)}" for k in range(12)]
    docs = frame(spark, [*texts, texts[3], prose(9, 70)], [*range(len(texts)), 3, None])
    cut = substring_dedup.without_repeated_passages(docs, most=most).fillna(NONE, ["doc_id"])
    assert listed(cut, "doc_id", "text", "n_words", "n_removed") == passages_by_hand(documents(docs), 20)


def test_ranges_follow_the_input(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART_TEXT", 500)
    docs = frame(spark)
    cut = substring_dedup.without_repeated_passages(docs).fillna(NONE, ["doc_id"])
    assert "part#" in cut._jdf.queryExecution().executedPlan().toString()
    size = sum(len((t or "").encode()) for t in odd_texts())
    assert f", {-(-size // 500)})" in cut._jdf.queryExecution().executedPlan().toString()
    assert listed(cut, "doc_id", "text", "n_words", "n_removed") == passages_by_hand(documents(docs), 20)


def near_by_hand(docs, threshold):
    sets, copies = {}, defaultdict(list)
    for i, t in docs:
        w = t.translate(LOW).encode().split()
        s = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        copies[s].append(i)
        sets[i] = s
    rep = {s: min(own) for s, own in copies.items()}
    links = {r: {q for t, q in rep.items() if q != r and len(s & t) >= threshold * len(s | t) and s & t} for s, r in rep.items()}
    group = {}
    for r in sorted(links):
        if r not in group:
            stack = [r]
            while stack:
                x = stack.pop()
                if x not in group:
                    group[x] = r
                    stack += links[x]
    return sorted(((i, rep[sets[i]], group[rep[sets[i]]], len(copies[sets[i]]), len(links[rep[sets[i]]]), i == group[rep[sets[i]]]) for i, _ in docs), key=repr)


NEAR = ("doc_id", "set_id", "class_id", "n_copies", "n_links", "kept")


def varied(seed, n, edits):
    pick, words = random.Random(seed), prose(77, n).split()
    for _ in range(edits):
        words[pick.randrange(n)] = f"edit{pick.randrange(9999)}"
    return " ".join(words)


def test_near_copies(spark):
    docs = odd(spark)
    got = ngram_join.joined(docs).fillna(NONE, ["doc_id", "class_id", "set_id"])
    assert listed(got, *NEAR) == near_by_hand(documents(docs), 0.8)


def test_many_near_copies(spark, monkeypatch):
    texts = [varied(k, 200, k % 9) for k in range(150)] + [varied(k, 120, k % 3) for k in range(40)] + [prose(k, 80) for k in range(60)]
    docs = frame(spark, texts)
    got = ngram_join.joined(docs)
    want = near_by_hand(documents(docs), 0.8)
    assert max(w[4] for w in want) > 50
    assert listed(got, *NEAR) == want
    monkeypatch.setattr(ngram_join, "BLOCK", 16)  # many cells per cluster
    assert listed(ngram_join.joined(docs), *NEAR) == want


def test_pruning_keeps_what_may_reach_the_threshold():
    needed = ngram_join.least_matches(0.8, 1e-6)
    assert list(needed) == [32, 64, 96, 128] and sorted(needed.values()) == list(needed.values())
    draws = np.random.default_rng(1).binomial(1, 0.8, (20_000, 128))
    assert all((draws[:, :k].sum(axis=1) >= m).mean() > 0.9999 for k, m in needed.items())
    assert needed[128] > 60


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (150, 200), (300, 300)]
    got = dict(ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 150: 100, 200: 100}


def test_empty_tables(spark):
    docs = empty(spark)
    assert line_dedup.without_repeated_lines(docs).count() == 0
    assert exact_dedup.equal_texts(docs).count() == 0
    assert substring_dedup.without_repeated_passages(docs).count() == 0
    assert ngram_join.joined(docs).count() == 0 and ngram_join.one_per_group(docs).count() == 0


@pytest.mark.parametrize("name", ["op4_line_dedup", "op7_exact_dedup", "op8_ngram_jaccard_join", "op10_substring_dedup"])
def test_answers(spark, tiny, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tiny}/documents.parquet'")
    assert compare(rows(entry.queries()[name](spark, tiny)), db.execute(entry.oracle_sql()[name]).df()) == ""
