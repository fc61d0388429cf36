"""Score texts by a log-bilinear neural language model and by smoothed word counts.

Counting covers every training document: tasks combine equal words of a batch, Spark adds them up by
the whole word. The ``vocabulary`` most frequent words have vectors of their own; all other words, seen or
not, share those of ``classes`` classes by hash, as targets and as contexts. The model predicts a
token's vector from those of the two before it (one matrix for each place); the probability of a
frequent word or a class is the softmax, over all of them, of its vector's product with the
prediction. Within a class a word's probability follows from its count.

Training is noise-contrastive: each partition runs over all its training texts, in numpy, telling
true tokens from noise drawn by frequency, and sends its parameters, a fixed amount, on; weighted means
of them form the model. Scoring multiplies in batches: each distinct pair of preceding tokens is
normalised once per worker, over the whole vocabulary, so the log probabilities are exact.

Words that aren't among the most frequent (``hot`` at most) go to Spark as (word, document) with their number in the
document and are joined with the counts; hot words are looked up in the task, which keeps frequent
words out of the shuffle. Both tables sent to all tasks have a bounded number of rows.

Contract of the results:

* Tokens: runs without blanks, A-Z lowered, and one end. Null or empty texts have the end alone.
* ``base_score`` sums log10((c + 1) / (N + 1 * (V + 1))); ``score`` is the model's log10 probability.
* Without training documents N and V are 0 and the model is the same for all words.
* Repeated rows are scored one by one and count as often as they occur. Within tasks words are told
  apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, lists, stored
from indicora.llm.textbytes import LOWER, U64, blocks, mixed, span_hashes, word_spans

VOCABULARY, CLASSES, HOT = 1024, 256, 50_000
SIZE, NOISE, MINIBATCH, RATE = 16, 64, 2048, 0.1
_SLOTS = 20
#: Rounds of training.
ROUNDS = 1


class Lookup:
    """Numbers of known hashes, by a table of their upper bits and a search among what shares them."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.maybe = np.zeros(1 << _SLOTS, bool)
        self.maybe[(hashes >> U64(64 - _SLOTS)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.sorted):
            return out
        some = np.flatnonzero(self.maybe[(h >> U64(64 - _SLOTS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.sorted, h[some]), len(self.sorted) - 1)
        good = self.sorted[at] == h[some]
        out[some[good]] = self.order[at[good]]
        return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([0, *map(len, words)])
    return span_hashes(np.frombuffer(b"".join(words), np.uint8), ends[:-1], ends[1:])


def _counts(batches: Batches) -> Batches:
    for batch in batches:
        found = []
        for _, data, offsets in blocks(batch):
            low = LOWER[data]
            start, end, _ = word_spans(low, offsets)
            keys, first, n = np.unique(span_hashes(low, start, end), return_index=True, return_counts=True)
            raw = low.tobytes()
            found.append((keys, n, [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]))
        keys, first, back = np.unique(np.concatenate([k for k, _, _ in found] or [np.zeros(0, U64)]), return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate([n for _, n, _ in found] or [np.zeros(0)]), len(keys)).astype(np.int64)
        words = [w for *_, own in found for w in own]
        yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in first.tolist()], pa.binary()), pa.array(n, pa.int64())], ["word", "n"])


@dataclass
class Vocabulary:
    """Frequent words by falling count, totals over all training tokens, and those of each class."""

    hashes: np.ndarray  # of the hot words
    counts: np.ndarray
    size: int  # words with vectors of their own
    tokens: int
    types: int
    docs: int
    class_tokens: np.ndarray | None = None  # one class of all other words unless given
    class_types: np.ndarray | None = None

    def __post_init__(self):
        if self.class_tokens is None:
            own = self.counts[: self.size].sum()
            self.class_tokens = np.array([int(self.tokens - self.docs - own)])
            self.class_types = np.array([max(0, self.types - (self.docs > 0) - self.size)])

    @property
    def other(self) -> int:
        """The first class."""
        return self.size

    @property
    def end(self) -> int:
        return self.size + len(self.class_tokens)

    @property
    def start(self) -> int:  # context only
        return self.end

    @property
    def targets(self) -> int:
        """Frequent words, classes, and the end."""
        return self.end + 1

    def numbers(self, found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Of words by their place among the hot ones (-1: none) and hash: themselves, or their class."""
        return np.where((found >= 0) & (found < self.size), found, self.size + class_of(hashes, len(self.class_tokens)))

    def frequencies(self) -> np.ndarray:
        """Of words, classes and the end among training tokens, one added to each."""
        n = np.r_[self.counts[: self.size], self.class_tokens, self.docs] + 1.0
        return n / n.sum()

    def within(self) -> np.ndarray:
        """log10 of N + V + 1 of each class; the one is for words never seen."""
        return np.log10(self.class_tokens + self.class_types + 1.0)


def class_of(hashes: np.ndarray, classes: int) -> np.ndarray:
    return (mixed(hashes) % U64(classes)).astype(np.int64)


def _class_sums(classes: int):
    """Tokens and types of a task's words by class."""

    def run(batches: Batches) -> Batches:
        total = np.zeros((2, classes), np.int64)
        for batch in batches:
            own = class_of(word_hashes(batch.column("word").to_pylist()), classes) if len(batch) else np.zeros(0, np.int64)
            total[0] += np.bincount(own, batch.column("n").to_numpy(), classes).astype(np.int64)
            total[1] += np.bincount(own, minlength=classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes, dtype=np.int32)), pa.array(total[0]), pa.array(total[1])], ["class", "n", "types"])

    return run


def counted(train: DataFrame, vocabulary: int = VOCABULARY, hot: int = HOT, classes: int = CLASSES) -> tuple[DataFrame, Vocabulary]:
    """Counts of all training words (word, n), the frequent ones, and the classes of all others."""
    counts = stored(train.select("text").mapInArrow(_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    docs = train.count()
    words, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # counts fall into some thousand steps of magnitude; the upper ones that hold ``hot`` words at most
    step = F.floor(F.log2("n") * 64)
    upper, held = None, 0
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect(), reverse=True):
        if held + row.k > hot:
            break
        upper, held = row.step, held + row.k
    top = counts.where(step >= upper).collect() if held else []
    top = sorted(top, key=lambda r: (-r.n, bytes(r.word)))
    hashes = word_hashes([bytes(r.word) for r in top]) if top else np.zeros(0, U64)
    size, n = min(vocabulary, len(top)), np.array([r.n for r in top], np.int64)
    classes = classes if words else 1
    sums = np.zeros((2, classes), np.int64)
    for row in counts.mapInArrow(_class_sums(classes), "class int, n long, types long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).collect():
        sums[:, row["class"]] = row.n, row.types
    own = class_of(hashes[:size], classes)  # frequent words are in no class
    sums -= np.stack([np.bincount(own, n[:size], classes), np.bincount(own, minlength=classes)]).astype(np.int64)
    return counts, Vocabulary(hashes, n, size, words + docs, types + (docs > 0), docs, *sums)


@dataclass
class Model:
    vectors: np.ndarray  # of context tokens
    places: np.ndarray  # 2 x SIZE x SIZE
    targets: np.ndarray
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.vectors, self.places, self.targets, self.bias)]).astype(np.float64)

    @staticmethod
    def shaped(flat: np.ndarray, n: int) -> Model:
        cut = np.cumsum([n * SIZE, 2 * SIZE * SIZE, n * SIZE])
        a, b, c, d = np.split(flat.astype(np.float32), cut)
        return Model(a.reshape(n, SIZE), b.reshape(2, SIZE, SIZE), c.reshape(n, SIZE), d)


def initial(vocab: Vocabulary, seed: int = 5) -> Model:
    random = np.random.default_rng(seed)
    n = vocab.targets
    small = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    return Model(small(n, SIZE), np.stack([np.eye(SIZE, dtype=np.float32), np.eye(SIZE, dtype=np.float32)]) + small(2, SIZE, SIZE), small(n, SIZE), np.log(vocab.frequencies()).astype(np.float32))


def tokens(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, text numbers and hashes of the words of some lowered texts."""
    start, end, doc = word_spans(low, offsets)
    return start, end, doc, span_hashes(low, start, end)


def stream(number: np.ndarray, doc: np.ndarray, texts: int, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every token with the two before it, and its text: (target, previous, one before, text)."""
    first = np.searchsorted(doc, np.arange(texts + 1))
    target = np.full(len(doc) + texts, vocab.end, np.int64)
    target[np.arange(len(doc)) + doc] = number
    begin = first[:-1] + np.arange(texts)
    owner = np.repeat(np.arange(texts), np.diff(first) + 1)
    place = np.arange(len(target)) - begin[owner]
    back = lambda k: np.where(place >= k, np.r_[np.full(k, vocab.start), target[:-k]][: len(target)], vocab.start)
    return target, back(1), back(2), owner


def _sums(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    own = ids[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    return own[first], np.add.reduceat(values[order], first, axis=0)


class Trainer:
    """Noise-contrastive Adagrad steps on one partition's tokens."""

    def __init__(self, model: Model, vocab: Vocabulary, seed: int):
        self.m, self.random = model, np.random.default_rng(seed)
        self.noise = vocab.frequencies()
        self.cumulated = np.cumsum(self.noise)
        self.level = np.log(NOISE * self.noise).astype(np.float32)
        self.squares = [np.full_like(x, 1e-6) for x in (model.vectors, model.places, model.targets, model.bias)]

    def _move(self, k: int, values: np.ndarray, at, slope: np.ndarray) -> None:
        self.squares[k][at] += slope * slope
        values[at] += RATE * slope / np.sqrt(self.squares[k][at])

    def learn(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        order = self.random.permutation(len(target))
        for a in range(0, len(order), MINIBATCH):
            at = order[a : a + MINIBATCH]
            self._step(target[at], one[at], two[at])

    def _step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, n = self.m, np.float32(len(target))
        noise = np.minimum(np.searchsorted(self.cumulated, self.random.random(NOISE)), len(self.noise) - 1)
        r1, r2, q, qn = m.vectors[one], m.vectors[two], m.targets[target], m.targets[noise]
        guess = r1 @ m.places[0] + r2 @ m.places[1]
        true = np.clip((guess * q).sum(axis=1) + m.bias[target] - self.level[target], -30, 30)
        false = np.clip(guess @ qn.T + m.bias[noise] - self.level[noise], -30, 30)
        pull = (1 / (1 + np.exp(true))) / n
        push = -1 / (1 + np.exp(-false)) / n
        back = pull[:, None] * q + push @ qn
        ids, slopes = _sums(np.r_[target, noise], np.r_[pull[:, None] * guess, push.T @ guess])
        self._move(2, m.targets, ids, slopes)
        ids, slopes = _sums(np.r_[target, noise], np.r_[pull, push.sum(axis=0)])
        self._move(3, m.bias, ids, slopes)
        ids, slopes = _sums(np.r_[one, two], np.r_[back @ m.places[0].T, back @ m.places[1].T])
        places = np.stack([r1.T @ back, r2.T @ back])
        self._move(0, m.vectors, ids, slopes)
        self._move(1, m.places, slice(None), places)


def _learned(shared):
    def run(batches: Batches) -> Batches:
        vocab, flat = shared.value
        trainer, look, seen = None, Lookup(vocab.hashes[: vocab.size]), 0
        for batch in batches:
            for slice_, data, offsets in blocks(batch):
                low = LOWER[data]
                _, _, doc, h = tokens(low, offsets)
                number = vocab.numbers(look(h), h)
                trainer = trainer or Trainer(Model.shaped(flat, vocab.targets), vocab, int(h[0] % U64(1 << 32)) if len(h) else 0)
                target, one, two, _ = stream(number, doc, len(slice_), vocab)
                trainer.learn(target, one, two)
                seen += len(target)
        if trainer:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(trainer.m.flat() * seen).tobytes()], pa.binary())], ["n", "total"])

    return run


def _added(batches: Batches) -> Batches:
    n, total = 0, 0.0
    for batch in batches:
        for k, raw in zip(batch.column("n").to_pylist(), batch.column("total").to_pylist()):
            n, total = n + k, total + np.frombuffer(raw)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["n", "total"])


def trained(train: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Model:
    """In each round every partition goes once over all its texts, from the mean of the round before;
    the parameters' weighted mean goes on."""
    flat = initial(vocab).flat()
    for _ in range(rounds):
        shared = train.sparkSession.sparkContext.broadcast((vocab, flat))
        own = train.select("text").mapInArrow(_learned(shared), "n long, total binary")
        # a few sums, each as large as one model, reach the driver
        rows = own.repartition(16).mapInArrow(_added, "n long, total binary").collect()
        if rows:
            flat = sum(np.frombuffer(bytes(r.total)) for r in rows) / sum(r.n for r in rows)
    return Model.shaped(flat, vocab.targets)


class Scorer:
    """Normalised log10 probabilities; each pair of preceding tokens is normalised once."""

    def __init__(self, model: Model, vocab: Vocabulary):
        self.m, self.n = model, vocab.targets
        self.first, self.second = model.vectors @ model.places[0], model.vectors @ model.places[1]
        self.norms = np.full(self.n * self.n, np.nan, np.float32)

    def __call__(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        pair = one * self.n + two
        new = np.unique(pair[np.isnan(self.norms[pair])])
        for a in range(0, len(new), 128):  # so few that their scores stay in the processor's cache
            k = new[a : a + 128]
            scores = (self.first[k // self.n] + self.second[k % self.n]) @ self.m.targets.T
            scores += self.m.bias
            top = np.zeros(len(k), np.float32)
            if not -60 < scores.min() <= scores.max() < 60:
                top = scores.max(axis=1)
                scores -= top[:, None]
            self.norms[k] = top + np.log(np.exp(scores, out=scores).sum(axis=1))
        guess = self.first[one] + self.second[two]
        scores = np.einsum("ij,ij->i", guess, self.m.targets[target]) + self.m.bias[target] - self.norms[pair]
        return scores.astype(np.float64) / np.log(10)


SCORED = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, hot_sum double, other_sum double, model_sum double, words array<binary>, times array<int>"


def _scores(shared):
    def run(batches: Batches) -> Batches:
        vocab, model = shared.value
        look, scorer = Lookup(vocab.hashes), Scorer(model, vocab)
        logs, within = np.log10(vocab.counts + 1.0), vocab.within()
        random = np.random.default_rng()
        for batch in batches:
            for slice_, data, offsets in blocks(batch):
                low = LOWER[data]
                start, end, doc, h = tokens(low, offsets)
                n = len(slice_)
                number = look(h)
                hot = number >= 0
                other = number >= vocab.size
                add = lambda d, w=None: np.bincount(d, w, n)
                own = vocab.numbers(number, h)
                shared_ = own >= vocab.size
                target, one, two, owner = stream(own, doc, n, vocab)
                # rare words: each once per text, with its number
                rare = np.flatnonzero(~hot)
                order = rare[np.lexsort((h[rare], doc[rare]))]
                firsts = np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])]) if len(order) else order
                times = np.diff(np.r_[firsts, len(order)])
                heads = order[firsts]
                raw = low.tobytes()
                ends = np.searchsorted(doc[heads], np.arange(n + 1))
                words = [raw[a:b] for a, b in zip(start[heads].tolist(), end[heads].tolist())]
                columns = [
                    pa.array(random.integers(-(1 << 63), (1 << 63) - 1, n), pa.int64()), slice_.column("doc_id").cast(pa.int64()), slice_.column("held_out"),
                    pa.array(add(doc) + 1, pa.int64()), pa.array(add(doc[hot]) + (vocab.docs > 0), pa.int64()),
                    pa.array(add(doc[hot], logs[number[hot]]) + np.log10(vocab.docs + 1.0), pa.float64()),
                    pa.array(add(doc[other], logs[number[other]]), pa.float64()),
                    pa.array(add(owner, scorer(target, one, two)) - add(doc[shared_], within[own[shared_] - vocab.size]), pa.float64()),
                    lists(words, ends, pa.binary()), lists(times.astype(np.int32), ends),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")])

    return run


def scored(docs: DataFrame, held_out, vocabulary: int = VOCABULARY, hot: int = HOT, classes: int = CLASSES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out``: a condition on the rows of ``docs``; the others are learned from.
    """
    rows = bounded_batches(docs).select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where("NOT held_out")
    counts, vocab = counted(train, vocabulary, hot, classes)
    model = trained(train, vocab)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, model))
    partial = stored(rows.mapInArrow(_scores(shared), SCORED), "scores")
    rare = (
        partial.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
        .join(counts, "word").groupBy("key").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_sum"))
    )
    every = float(np.log10(vocab.tokens + vocab.types + 1.0))
    known = lambda c: F.coalesce(c, F.lit(0))
    return partial.drop("words", "times").join(rare, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known("rare_known")).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + known("rare_sum") - F.col("n_tokens") * every).alias("base_score"),
        (F.col("model_sum") + F.col("other_sum") + known("rare_sum")).alias("score"),
    )
