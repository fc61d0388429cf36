"""Find licence statements by ordered signature rules.

A text is reduced to canonical words. Gate words decide which of some hundred rules are tried at
all. A detection stays unless a stronger one covers it: rules are ordered by priority, and an
interval that lies inside one already kept, of the same or a stronger priority, is suppressed; of
equal priority the longer one wins. Base phrases have the highest priority and always stay.

Contract of the results:

* Words are runs of digits, letters and bytes beyond ASCII, A-Z lowered, numbered from 0 per text.
* A base place is a place where a base phrase's words stand one after the other; all are counted.
* Null or empty texts have no words, no labels (empty strings), null first and last word, score 0.
* The score is that of the strongest detection that stays, 0 without any.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from indicora.llm.common import Batches, bounded_batches, extended, with_columns
from indicora.llm.license_rules import BASE, Rule, rules
from indicora.llm.textbytes import LOWER, NOT_WORD, blocks, word_spans

_BLANKED = LOWER.copy()
_BLANKED[NOT_WORD] = 0x20
Detection = tuple[int, int, str, int, float]  # first word, last word, label, priority, score


@lru_cache(1)
def _rules() -> tuple[tuple[bytes, tuple[Rule, ...]], ...]:
    """Rules by their first gate word, which is the rarest."""
    gates: dict[bytes, list[Rule]] = {}
    for rule in rules():
        gates.setdefault(rule.gates[0], []).append(rule)
    return tuple((g, tuple(r)) for g, r in gates.items())


def suppressed(found: list[Detection]) -> list[Detection]:
    """Detections that stay, in order of place.

    Strongest first, longer ones first among equals. Kept intervals that no other kept one covers are
    held in order of start, and so of end as well: an interval is covered if the last one that
    begins no later also ends no earlier.
    """
    kept: list[Detection] = []
    starts: list[int] = []
    ends: list[int] = []
    for d in sorted(set(found), key=lambda d: (d[3], d[0] - d[1], d[0], d[2])):
        at = bisect_right(starts, d[0])
        covered = at > 0 and ends[at - 1] >= d[1]
        if d[3] == 0 or not covered:
            kept.append(d)
        if not covered:
            first = bisect_left(starts, d[0])
            past = bisect_right(ends, d[1], first)  # those that it covers in turn
            starts[first:past], ends[first:past] = [d[0]], [d[1]]
    return sorted(kept)


def detections(text: bytes) -> list[Detection]:
    """Detections in a canonical text: blanks at both ends, one between words."""
    found: list[Detection] = []
    for gate, own in _rules():
        if gate not in text:
            continue
        for rule in own:
            if not all(g in text for g in rule.gates[1:]):
                continue
            found += [(m.start(), m.end(), rule.label, rule.priority, rule.score) for m in rule.pattern.finditer(text)]
    if not found:
        return []
    words = np.cumsum(np.frombuffer(text, np.uint8) == 0x20)
    return suppressed([(int(words[a]) - 1, int(words[b - 1]) - 1, *rest) for a, b, *rest in found])


def _scan(batches: Batches) -> Batches:
    base = {label for _, label in BASE}
    for batch in batches:
        rows: list[tuple] = []
        for slice_, data, offsets in blocks(batch):
            blanked = _BLANKED[data]
            start, _, doc = word_spans(blanked, offsets, NOT_WORD)
            counts = np.bincount(doc, minlength=len(slice_)).tolist()
            raw = blanked.tobytes()
            gates = [(g, r) for g, r in _rules() if g in raw]
            for t, n in enumerate(counts):
                text = raw[offsets[t] : offsets[t + 1]]
                if not any(g in text for g, _ in gates):
                    rows.append((n, 0, None, None, "", "", 0.0, []))
                    continue
                kept = detections(b" " + b" ".join(text.split()) + b" ")
                own = [d for d in kept if d[3] == 0]
                labels = {d[2] for d in kept}
                rows.append((
                    n, len(own), min((d[0] for d in own), default=None), max((d[0] for d in own), default=None),
                    ",".join(sorted({d[2] for d in own} & base)), ",".join(sorted(labels)), max((d[4] for d in kept), default=0.0),
                    [{"first": a, "last": b, "label": label, "score": s} for a, b, label, _, s in kept],
                ))
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))
        kinds = (pa.int64(),) * 4 + (pa.string(),) * 2 + (pa.float64(), span)
        yield extended(batch.drop_columns(["text"]), **{n: pa.array(c, k) for n, c, k in zip(names, zip(*rows) if rows else [[]] * 8, kinds)})


def scanned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without their text, with counts, labels, score and all detections."""
    schema = with_columns(
        docs.drop("text").schema, n_words="bigint", n_base="bigint", first_word="bigint", last_word="bigint",
        base_labels="string", labels="string", score="double",
        detections="array<struct<first: bigint, last: bigint, label: string, score: double>>",
    )
    return bounded_batches(docs).mapInArrow(_scan, schema)
