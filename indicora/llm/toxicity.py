"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its words (A-Z lowered) and the words' beginnings, hashed to a fixed number of
places. The machine adds a weight per term and, for every pair of terms, the product of two learned
vectors; so a pair such as an insult next to a group's name counts beyond the sum of its parts. It is
trained here, in numpy, on hashed terms of a bounded sample of labelled rows: at most ``per_class``
rows of each label, those of smallest hashed id. Weights restore the labels' true shares, so scores
are probabilities. Only the label, never language, source or id, is told to the machine.

Contract of the results:

* One row per input row; a null or empty text has no terms and gets the bias alone.
* A document labelled several times counts as toxic if any label says so; null labels are ignored.
* Without labelled rows, or with one label only, the score is the share of toxic rows (0 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, extended, with_columns
from indicora.llm.textbytes import LOWER, NOT_WORD, U64, blocks, span_hashes, word_spans

PLACE_BITS = 18
PREFIXES = (4, 5, 6)


@dataclass
class Machine:
    """``score = bias + sum w_i + sum over pairs <v_i, v_j> / n`` for the n terms of a text."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margins(self, terms: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = np.diff(offsets)
        v = self.vectors[terms]
        total, squares = _sums(v, offsets), _sums(v * v, offsets)
        pairs = 0.5 * (total * total - squares).sum(axis=1) / np.maximum(n, 1)
        return self.bias + _sums(self.weights[terms], offsets) + pairs

    def scores(self, terms: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(terms, offsets), -30, 30)))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; empty runs give 0."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]))
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(values, offsets[some], axis=0)
    return out


def hashed_terms(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, end to end, and where each text's begin."""
    flat, sizes = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for slice_, data, offsets in blocks(batch):
        low = LOWER[data]
        start, end, doc = word_spans(low, offsets, NOT_WORD)
        keys = [span_hashes(low, start, end)]
        docs = [doc]
        for k in PREFIXES:
            longer = end - start > k
            keys.append(span_hashes(low, start[longer], start[longer] + k) * U64(2 * k + 1))
            docs.append(doc[longer])
        place = (np.concatenate(keys) >> U64(64 - PLACE_BITS)).astype(np.int64)
        pairs = np.unique(np.concatenate(docs) << PLACE_BITS | place)
        flat.append(pairs & ((1 << PLACE_BITS) - 1))
        sizes.append(np.bincount(pairs >> PLACE_BITS, minlength=len(slice_)))
    return np.concatenate(flat), np.cumsum(np.concatenate(sizes))


def fit(terms: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, *, rank: int = 6, epochs: int = 12, batch: int = 64, rate: float = 0.7, decay: float = 1e-5, sparse: float = 3e-4, least: int = 2, seed: int = 7) -> Machine:
    """Adagrad over shuffled rows. Learned are all terms in ``least`` rows or more, also those that
    tell nothing alone: they may in pairs. ``sparse`` draws weights to zero (an L1 penalty, taken as
    a proximal step where a term occurs), which keeps chance finds of rare terms small."""
    random = np.random.default_rng(seed)
    size = 1 << PLACE_BITS
    known = np.flatnonzero(np.bincount(np.concatenate(terms), minlength=size) >= least)
    place = np.full(size, -1, np.int64)
    place[known] = np.arange(len(known))
    rows = [(at := place[t])[at >= 0] for t in terms]
    share = float(np.clip(np.average(toxic, weights=weight), 1e-6, 1 - 1e-6))
    bias, weights, vectors = np.log(share / (1 - share)), np.zeros(len(known)), random.normal(0, 0.02, (rank, len(known)))
    sq_w, sq_v, sq_b = np.full(len(known), 1e-3), np.full((rank, len(known)), 1e-3), 1e-3
    number = np.zeros(len(known), np.int64)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            n = np.array([len(rows[i]) for i in pick])
            offsets = np.r_[0, np.cumsum(n)]
            flat = np.concatenate([rows[i] for i in pick])
            here = np.zeros(len(known), bool)
            here[flat] = True
            used = np.flatnonzero(here)
            number[used] = np.arange(len(used))
            at, doc = number[flat], np.repeat(np.arange(len(pick)), n)
            own, v = weights[used], vectors[:, used]
            total = [_sums(x[at], offsets) for x in v]
            pairs = 0.5 * (sum(t * t for t in total) - _sums((v * v).sum(axis=0)[at], offsets)) / np.maximum(n, 1)
            score = 1 / (1 + np.exp(-np.clip(bias + _sums(own[at], offsets) + pairs, -30, 30)))
            error = (score - toxic[pick]) * weight[pick] / batch
            bias -= rate * error.sum() / np.sqrt(sq_b := sq_b + error.sum() ** 2)
            if not len(flat):
                continue
            g = np.bincount(at, error[doc], len(used)) + decay * own
            sq_w[used] += g * g
            step = rate / np.sqrt(sq_w[used])
            moved = own - step * g
            weights[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * sparse, 0)
            each = error / np.maximum(n, 1)
            every = np.bincount(at, each[doc], len(used))
            for f in range(rank):
                g = np.bincount(at, (total[f] * each)[doc], len(used)) - v[f] * every + decay * v[f]
                sq_v[f, used] += g * g
                vectors[f, used] -= rate * g / np.sqrt(sq_v[f, used])
    machine = Machine(bias, np.zeros(size), np.zeros((size, rank)))
    machine.weights[known], machine.vectors[known] = weights, vectors.T
    return machine


def _terms(batches: Batches) -> Batches:
    for batch in batches:
        flat, offsets = hashed_terms(batch)
        packed = [flat[a:b].astype(np.uint32).tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("_toxic"), batch.column("_weight"), pa.array(packed, pa.binary())], ["toxic", "weight", "terms"])


def trained(docs: DataFrame, labels: DataFrame, per_class: int = 5000) -> Machine:
    """Fit on labelled rows of ``docs``; ``labels`` has doc_id and toxic of the rows to learn from."""
    truth = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    shares = {r["_toxic"]: r["n"] for r in truth.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        share = min(max(float(sum(k * n for k, n in shares.items()) / max(1, sum(shares.values()))), 1e-9), 1 - 1e-9)
        return Machine(float(np.log(share / (1 - share))), np.zeros(1 << PLACE_BITS), np.zeros((1 << PLACE_BITS, 1)))
    picks = None
    for label, n in shares.items():
        part = truth.where(F.col("_toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).withColumn("_weight", F.lit(n / min(n, per_class)))
        picks = part if picks is None else picks.unionByName(part)
    # at most 2 * per_class rows of three numbers
    rows = bounded_batches(docs).select("doc_id", "text").join(F.broadcast(picks), "doc_id").mapInArrow(_terms, "toxic int, weight double, terms binary").collect()
    if not rows:
        return Machine(-20.0, np.zeros(1 << PLACE_BITS), np.zeros((1 << PLACE_BITS, 1)))
    rows = sorted(rows, key=lambda r: (r.toxic, bytes(r.terms)))
    weight = np.array([r.weight for r in rows])
    return fit([np.frombuffer(r.terms, np.uint32).astype(np.int64) for r in rows], np.array([r.toxic for r in rows], float), weight / weight.mean())


def _scores(shared):
    """Scores of the texts of a batch, in a task."""

    def start():
        bias, used, weights, vectors = shared.value
        place = np.full(1 << PLACE_BITS, -1, np.int64)
        place[used] = np.arange(len(used))
        machine = Machine(bias, weights, vectors)

        def score(batch: pa.RecordBatch) -> np.ndarray:
            out = [np.zeros(0)]
            for part, _, _ in blocks(batch):
                flat, offsets = hashed_terms(part)
                at = place[flat]
                kept, at = np.r_[0, np.cumsum(at >= 0)][offsets], at[at >= 0]
                out.append(machine.scores(at, kept))
            return np.concatenate(out)

        return score

    return start


def _sent(docs: DataFrame, machine: Machine):
    """What a task needs: the terms learned, at most as many as there are places."""
    used = np.flatnonzero(machine.weights.astype(bool) | machine.vectors.any(axis=1))
    return bounded_batches(docs).sparkSession.sparkContext.broadcast((machine.bias, used, machine.weights[used], machine.vectors[used]))


def scored(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``predicted``."""
    start = _scores(_sent(docs, machine))

    def run(batches: Batches) -> Batches:
        score = start()
        for batch in batches:
            scores = score(batch)
            yield extended(batch, score=pa.array(scores, pa.float64()), predicted=pa.array((scores >= threshold).astype(np.int32), pa.int32()))

    return docs.mapInArrow(run, with_columns(docs.schema, score="double", predicted="int"))


def accepted(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    start = _scores(_sent(docs, machine))

    def run(batches: Batches) -> Batches:
        score = start()
        for batch in batches:
            yield batch.filter(pa.array(score(batch) < threshold))

    return docs.mapInArrow(run, docs.schema)
