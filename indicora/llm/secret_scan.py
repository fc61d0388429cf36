"""Find secrets: fixed patterns, and a character convolutional network for what they miss.

Every run of ``CANDIDATE_LEAST`` or more characters that may stand in a key is a candidate, whatever
it looks like. The network (numpy, trained here) reads a candidate with the characters around it, a
long one in overlapping windows of which the highest counts:
one-hot character classes, convolution filters over widths of five characters, the maximum of each
filter, one output. Its labelled findings are the corpus's own: candidates that a pattern found are
secrets; candidates that no pattern touched and that read as words, numbers or addresses are not.
What is neither is left unlabelled and only scored. Patterns know a few formats only, so findings are
widened: secrets are written anew in other alphabets, lengths, groups and prefixes, words in other
cases and compounds, each in its own or a neutral context. Some formats are held back from training.
The threshold is the largest score that finds ``recall`` of all labelled findings of the corpus (from
a histogram made by the tasks) and ``FORMAT_RECALL`` of each format held back.

Contract of the results:

* Base spans are leftmost and non-overlapping per kind, at most one per match, ends exclusive, in
  code points; matches that are too short are dropped, and what they covered is not searched again.
* The network adds spans of kind ``model`` for candidates that overlap no base span. Base ones stay.
* Null or empty texts have no spans. Without findings to learn from, the network adds none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, extended, stored, with_columns
from indicora.llm.textbytes import blocks, word_spans

#: Kinds in order, patterns, the part measured and its least length.
PATTERNS = (
    ("assign", rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", rb"AKIA[A-Z0-9]+", 0, 16),
    ("hex", rb"[0-9a-f]+", 0, 32),
)
KINDS = (*(p[0] for p in PATTERNS), "model")
_ASSIGN, _ACCESS = re.compile(PATTERNS[0][1]), re.compile(PATTERNS[1][1])
_GATES = (b"pass", b"secret", b"token", b"api")

#: Bytes of candidates; all others, also what joins a name and its value, end one.
_KEY = np.ones(256, bool)
_KEY[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-"]] = False
_HEX = np.ones(256, bool)
_HEX[[*b"0123456789abcdef"]] = False
CANDIDATE_LEAST = 8

#: Characters read: before a window, of the candidate, after it; and how far apart windows begin.
BEFORE, BODY, AFTER = 20, 40, 8
STRIDE = 16
WIDTH = BEFORE + BODY + AFTER
FILTER = 5


def _classes() -> np.ndarray:
    """Character classes: a digit, a..f, other lower, A..F, other upper, and signs, each its own."""
    out = np.zeros(256, np.int64)
    kinds = ["", "0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", " ", "\n\t\r", "=", ":", "\"'", "_-", "/", "+", ".", "@", ",;!?", "()[]{}<>|"]
    for k, chars in enumerate(kinds):
        out[[*chars.encode()]] = k
    out[0x80:] = len(kinds)
    return out


CLASS = _classes()
CLASSES = int(CLASS.max()) + 2
_PAD = CLASSES - 1


def base_spans(text: bytes, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind number) in bytes. ``hex_runs``: maximal runs of hex digits long enough."""
    found = [(a, b, 2) for a, b in hex_runs]
    low = text.lower()
    if any(g in low for g in _GATES):
        found += [(*m.span(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= PATTERNS[0][3]]
    if b"AKIA" in text:
        found += [(*m.span(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= PATTERNS[1][3]]
    return sorted(found)


def _long_runs(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
    start, end, doc = word_spans(data, offsets, apart)
    long = np.flatnonzero(end - start >= least)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    for a, b, t in zip(start[long].tolist(), end[long].tolist(), doc[long].tolist()):
        out[t].append((a - int(offsets[t]), b - int(offsets[t])))
    return out


def parts(a: int, b: int) -> list[tuple[int, int]]:
    """Windows of at most ``BODY`` bytes that cover a candidate; one if it is no longer."""
    starts = [*range(a, max(a, b - BODY), STRIDE), max(a, b - BODY)]
    return [(k, min(b, k + BODY)) for k in starts]


def windows(text: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Class numbers around each window; its beginning has a fixed place."""
    if not spans:
        return np.zeros((0, WIDTH), np.int8)
    a, b = np.array(spans, np.int64).T
    padded = np.full(len(text) + BEFORE + BODY + AFTER, _PAD, np.int8)
    padded[BEFORE : BEFORE + len(text)] = CLASS[text]
    around = np.lib.stride_tricks.sliding_window_view(padded, BEFORE + BODY)[a].copy()
    around[np.arange(BEFORE + BODY) >= (BEFORE + b - a)[:, None]] = _PAD
    after = np.lib.stride_tricks.sliding_window_view(padded, AFTER)[BEFORE + b]
    return np.concatenate([around, after], axis=1)


_WORDLIKE = re.compile(rb"[A-Za-z]+[.,]?|[A-Z]?[a-z]+(?:-[a-z]+)*|[0-9.,-]+|[a-z0-9._+-]+\.(?:com|org|net|example)|(?:https?:)?//\S+")
#: Letters or digits apart: what may be learned as no secret further along a candidate.
_PLAIN = re.compile(rb"(?:[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+)(?:[^A-Za-z0-9]+(?:[A-Za-z]+|[0-9]+))*[^A-Za-z0-9]*")


@dataclass
class Network:
    filters: np.ndarray  # FILTER x CLASSES x F
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    threshold: float = 1.1

    def hidden(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter and where; the filters are summed by character lookup."""
        n = rows.shape[1] - FILTER + 1
        total = np.zeros((len(rows), n, self.filters.shape[2]), np.float32)
        for k in range(FILTER):
            total += self.filters[k][rows[:, k : k + n]]
        at = total.argmax(axis=1)
        return np.maximum(np.take_along_axis(total, at[:, None], 1)[:, 0] + self.bias, 0), at

    @cached_property
    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """What the filters give for every three classes in a row, and for the two that follow."""
        one, two, three, four, five = self.filters
        threes = one[:, None, None] + two[None, :, None] + three[None, None]
        return threes.reshape(CLASSES**3, -1), (four[:, None] + five[None]).reshape(CLASSES**2, -1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        threes, twos = self.runs
        for a in range(0, len(rows), 128):
            part = rows[a : a + 128].astype(np.int32)
            pairs = part[:, :-1] * CLASSES + part[:, 1:]
            total = threes[pairs[:, :-3] * CLASSES + part[:, 2:-2]]
            total += twos[pairs[:, 3:]]
            h = np.maximum(total.max(axis=1) + self.bias, 0)
            out.append(1 / (1 + np.exp(-np.clip(h @ self.out + self.out_bias, -30, 30))))
        return np.concatenate(out)


def fit(rows: np.ndarray, secret: np.ndarray, *, filters: int = 48, epochs: int = 10, batch: int = 64, rate: float = 0.05, seed: int = 11) -> Network:
    """Train by Adagrad, half of the time on the candidate alone."""
    random = np.random.default_rng(seed)
    own = random.permutation(len(rows))
    net = Network(random.normal(0, 0.2, (FILTER, CLASSES, filters)).astype(np.float32), np.zeros(filters, np.float32), random.normal(0, 0.2, filters).astype(np.float32), 0.0)
    squares = [np.full_like(net.filters, 1e-4), np.full_like(net.bias, 1e-4), np.full_like(net.out, 1e-4), 1e-4]
    weight = np.where(secret, len(secret) / max(1, 2 * secret.sum()), len(secret) / max(1, 2 * (~secret).sum()))
    for _ in range(epochs):
        for a in range(0, len(own), batch):
            pick = own[a : a + batch]
            x = rows[pick].copy()
            blind = random.random(len(x)) < 0.5  # what stands around must not decide alone
            x[blind, :BEFORE] = x[blind, BEFORE + BODY :] = _PAD
            h, at = net.hidden(x)
            p = 1 / (1 + np.exp(-np.clip(h @ net.out + net.out_bias, -30, 30)))
            error = ((p - secret[pick]) * weight[pick] / len(pick)).astype(np.float32)
            back = error[:, None] * net.out * (h > 0)
            slopes = [np.zeros_like(net.filters), back.sum(axis=0), h.T @ error, float(error.sum())]
            f = np.broadcast_to(np.arange(h.shape[1]), at.shape)
            for k in range(FILTER):
                np.add.at(slopes[0][k], (np.take_along_axis(x, at + k, 1), f), back)
            for i, name in enumerate(("filters", "bias", "out", "out_bias")):
                squares[i] = squares[i] + slopes[i] ** 2
                setattr(net, name, getattr(net, name) - rate * slopes[i] / np.sqrt(squares[i]))
        random.shuffle(own)
    return net


_LOWER, _UPPER, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
#: Alphabet, least and largest length of a group, groups, what joins them, whether a prefix stands before.
FORMATS = {
    "hex": (b"0123456789abcdef", 16, 64, 1, b"", False),
    "mixed": (_LOWER + _UPPER + _DIGITS, 12, 48, 1, b"", False),
    "base64": (_LOWER + _UPPER + _DIGITS + b"+/", 20, 64, 1, b"", False),
    "upper": (_UPPER + _DIGITS, 16, 40, 1, b"", False),
    "lower": (_LOWER + _DIGITS, 14, 40, 1, b"", False),
    "prefixed": (_LOWER + _UPPER + _DIGITS, 16, 40, 1, b"", True),
    "dashed": (b"0123456789abcdef", 4, 12, 5, b"-", False),
}
#: Never learned; the threshold must find them.
HELD_FORMATS = {
    "upper hex": (b"0123456789ABCDEF", 28, 40, 1, b"", False),
    "dotted": (_LOWER + _UPPER + _DIGITS + b"_-", 16, 40, 3, b".", False),
    "underscored": (_LOWER + _UPPER + _DIGITS, 10, 24, 2, b"_", True),
    "short": (_LOWER + _UPPER + _DIGITS, 12, 14, 1, b"", False),
}
FORMAT_RECALL = 0.92


def written(form: tuple, random: np.random.Generator) -> bytes:
    """A secret in a format: every group holds a digit and a letter, as random ones of this length do."""
    letters, least, most, groups, joint, prefixed = form
    draw = lambda: bytes(random.choice(np.frombuffer(letters, np.uint8), random.integers(least, most + 1)))
    parts = [draw() for _ in range(groups)]
    head = bytes(random.choice(np.frombuffer(_LOWER, np.uint8), random.integers(2, 5))) + (b"_" if random.random() < 0.5 else b"-") if prefixed else b""
    return head + joint.join(parts)


def _plain_again(words: list[bytes], random: np.random.Generator) -> bytes:
    """Something that is no secret, made of candidates that are none: other cases, compounds, numbers."""
    one, two = (words[random.integers(len(words))] for _ in range(2))
    joint = (b"-", b"_", b".", b"/", b"")[random.integers(5)]
    two = two.title() if joint == b"" else two
    number = str(random.integers(1, 3000)).encode()
    made = (one.upper(), one.title(), one + joint + two, one + joint + number, one + b"-" + number + b"." + number, one + b"/" + two + b"/" + one)
    return made[random.integers(len(made))]


def placed(value: bytes, around: np.ndarray) -> np.ndarray:
    """The window at the beginning of a value that stands where another one stood."""
    row = np.full(WIDTH, _PAD, np.int8)
    row[:BEFORE], row[BEFORE + BODY :] = around[:BEFORE], around[BEFORE + BODY :]
    kinds = CLASS[np.frombuffer(value, np.uint8)].astype(np.int8)
    row[BEFORE : BEFORE + min(BODY, len(kinds))] = kinds[:BODY]
    rest = kinds[BODY : BODY + AFTER]
    row[BEFORE + BODY : BEFORE + BODY + len(rest)] = rest
    return row


def widened(rows: np.ndarray, candidates: list[bytes], secret: np.ndarray, most: int = 6000, seed: int = 5) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Findings with others written after them, half secrets, and windows of each held-back format."""
    random = np.random.default_rng(seed)
    words = [c for c, s in zip(candidates, secret) if not s and c[:1].isalpha()] or [b"plain"]
    n = min(most, 4 * len(rows)) // 2
    around = lambda s: rows[random.choice(np.flatnonzero(secret if s and random.random() < 0.5 else ~secret))]
    forms = list(FORMATS.values())
    more = [placed(written(forms[k % len(forms)], random), around(True)) for k in range(n)]
    more += [placed(_plain_again(words, random), around(False)) for _ in range(n)]
    held = {name: np.stack([placed(written(form, random), around(k % 2 == 0)) for k in range(400)]) for name, form in HELD_FORMATS.items()}
    return np.concatenate([rows, np.stack(more)]), np.r_[secret, np.ones(n, bool), np.zeros(n, bool)], held


def overlaps(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[bool]:
    """Which spans overlap a base span; ``base`` is sorted by start."""
    starts, ends = np.array([x[0] for x in base]), np.maximum.accumulate([x[1] for x in base])
    last = np.searchsorted(starts, [b for _, b in spans], "left")  # base spans that begin before a span ends
    reach = np.r_[-1, ends][last]
    return (reach > np.array([a for a, _ in spans])).tolist()


def _texts(batch: pa.RecordBatch):
    """For each text: bytes, base spans, candidates that overlap none, candidates inside one."""
    for _, data, offsets in blocks(batch):
        hexes = _long_runs(data, offsets, _HEX, PATTERNS[2][3])
        keys = _long_runs(data, offsets, _KEY, CANDIDATE_LEAST)
        raw = data.tobytes()
        for t in range(len(offsets) - 1):
            text = raw[offsets[t] : offsets[t + 1]]
            base = base_spans(text, hexes[t])
            if not base or not keys[t]:
                yield text, base, keys[t], []
                continue
            touched = overlaps(keys[t], base)
            yield text, base, [c for c, x in zip(keys[t], touched) if not x], [c for c, x in zip(keys[t], touched) if x]


def _found(text: bytes, base: list, apart: list, within: list) -> tuple[list, list]:
    """Windows of a text that are labelled: those of secrets and those of none."""
    yes = [p for c in within for p in parts(*c)]
    yes = [p for p, x in zip(yes, overlaps(yes, base)) if x] if yes else []
    no = [p for c in apart if _WORDLIKE.fullmatch(text[c[0] : c[1]]) for p in parts(*c) if p[0] == c[0] or _PLAIN.fullmatch(text[p[0] : p[1]])]
    return yes, no


def _sampled(per_label: int):
    """Of a task's labelled windows, those of smallest hash for each label."""

    def run(batches: Batches) -> Batches:
        held: list[dict[int, tuple[bytes, bytes]]] = [{}, {}]

        def trim(own: dict) -> dict:
            return {h: own[h] for h in sorted(own)[:per_label]}

        for batch in batches:
            for text, *rest in _texts(batch):
                for label, spans in enumerate(reversed(_found(text, *rest))):
                    data = np.frombuffer(text, np.uint8)
                    for at in range(0, len(spans), SLICE):
                        for (a, b), row in zip(spans[at : at + SLICE], windows(data, spans[at : at + SLICE])):
                            held[label].setdefault(xxhash.xxh3_64_intdigest(raw := row.tobytes() + text[a:b]) >> 1, (raw[:WIDTH], text[a:b]))
                        if len(held[label]) > 4 * per_label:
                            held[label] = trim(held[label])
        rows = [(label == 1, h, *x) for label in (0, 1) for h, x in trim(held[label]).items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.bool_(), pa.int64(), pa.binary(), pa.binary()))], ["secret", "h", "window", "candidate"])

    return run


#: Bins of the histogram of scores, and windows scored at a time.
BINS, SLICE = 1000, 1 << 14


def _histogram(shared):
    """How many labelled secrets of a task score in each bin, with and without what stands around."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for text, *rest in _texts(batch):
                yes, _ = _found(text, *rest) if rest[2] else ([], [])
                for at in range(0, len(yes), SLICE):
                    rows = windows(np.frombuffer(text, np.uint8), yes[at : at + SLICE])
                    alone = rows.copy()
                    alone[:, :BEFORE] = alone[:, BEFORE + BODY :] = _PAD
                    score = np.minimum(shared.value.scores(rows), shared.value.scores(alone))
                    total += np.bincount(np.minimum((score * BINS).astype(np.int64), BINS - 1), minlength=BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bin", "n"])

    return run


def calibrated(net: Network, texts: DataFrame, held: dict[str, np.ndarray], recall: float) -> float:
    """The largest threshold that finds ``recall`` of all findings and ``FORMAT_RECALL`` of each held-back format."""
    shared = texts.sparkSession.sparkContext.broadcast(net)
    counts = np.zeros(BINS, np.int64)
    for k, n in texts.mapInArrow(_histogram(shared), "bin int, n long").groupBy("bin").agg(F.sum("n")).collect():
        counts[k] = n
    above = np.cumsum(counts[::-1])[::-1]  # findings that score in a bin or above it
    own = float(np.flatnonzero(above >= recall * above[0])[-1]) / BINS
    return min(own, *(float(np.sort(net.scores(rows))[int((1 - FORMAT_RECALL) * len(rows))]) for rows in held.values()))


def trained(docs: DataFrame, per_label: int = 4000, recall: float = 0.98) -> Network:
    """Fit on a bounded sample of labelled findings (of each label those of smallest hash), calibrate on all."""
    texts = bounded_batches(docs).select("text")
    own = stored(texts.mapInArrow(_sampled(per_label), "secret boolean, h long, window binary, candidate binary"), "secret-findings")
    rows = []
    for label in (True, False):
        rows += own.where(F.col("secret") == label).distinct().orderBy("h", "window").limit(per_label).collect()
    secret = np.array([r.secret for r in rows], bool)
    if not secret.any() or secret.all():
        none = np.zeros(1, np.float32)
        return Network(np.zeros((FILTER, CLASSES, 1), np.float32), none, none, 0.0)
    found = np.stack([np.frombuffer(r.window, np.int8) for r in rows])
    found, secret, held = widened(found, [bytes(r.candidate) for r in rows], secret)
    net = fit(found, secret)
    net.threshold = calibrated(net, texts, held, recall)
    return net


def _places(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets as code points."""
    if text.isascii() or not spans:
        return spans
    lead = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    at = np.r_[0, lead]
    return [(int(at[a]), int(at[b]), k) for a, b, k in spans]


def scanned(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` without their text, with counts, ``base`` and ``spans`` (kind:start:end)."""
    shared = bounded_batches(docs).sparkSession.sparkContext.broadcast(net)

    def run(batches: Batches) -> Batches:
        net = shared.value
        for batch in batches:
            texts, scores, waiting, n = [], [], [], 0

            def score() -> None:
                if waiting:
                    rows = np.concatenate([windows(data, spans) for data, spans, _ in waiting])
                    heads = np.concatenate([h for *_, h in waiting])
                    # a candidate scores as its highest window
                    scores.append(np.maximum.reduceat(net.scores(rows), np.cumsum(heads) - heads))
                    waiting.clear()

            first = 0
            for text, base, apart, _ in _texts(batch):
                texts.append((text, base, apart, first))
                first += len(apart)
                data = np.frombuffer(text, np.uint8)
                for at in range(0, len(apart), SLICE // 8):
                    read = [parts(*c) for c in apart[at : at + SLICE // 8]]
                    waiting.append((data, [p for own in read for p in own], np.array([len(own) for own in read])))
                    n += len(waiting[-1][1])
                    if n > SLICE:
                        score()
                        n = 0
            score()
            scores = np.concatenate(scores) if scores else np.zeros(0)
            out = []
            for text, base, apart, first in texts:
                more = [(a, b, 3) for (a, b), s in zip(apart, scores[first : first + len(apart)]) if s >= net.threshold]
                shown = [(f"{KINDS[k]}:{a}:{b}", k) for a, b, k in sorted(_places(text, base + more), key=lambda s: (s[0], s[2]))]
                kinds = [k for _, _, k in base]
                out.append((*(kinds.count(k) for k in range(3)), ",".join(s for s, k in shown if k < 3), ",".join(s for s, _ in shown)))
            names = ("n_assign", "n_access", "n_hex", "base", "spans")
            yield extended(batch.drop_columns(["text"]), **{n: pa.array(c, pa.int64() if i < 3 else pa.string()) for i, (n, c) in enumerate(zip(names, zip(*out) if out else [[]] * 5))})

    schema = with_columns(docs.drop("text").schema, n_assign="bigint", n_access="bigint", n_hex="bigint", base="string", spans="string")
    return docs.mapInArrow(run, schema)
