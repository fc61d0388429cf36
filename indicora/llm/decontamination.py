"""Find passages of benchmark items in documents, also slightly changed ones.

Q-gram lemma filtering. Two passages of ``L`` characters within ``k`` edits share at least
``L + 1 - q (k + 1)`` q-grams, and these lie in a band of ``k`` neighbouring diagonals (place in the
document less place in the item). Tasks look up every q-gram of a document in the items' q-grams,
put each hit into the two overlapping bands of diagonals that hold it, and keep stretches of a band
that hold enough hits within ``L`` characters. Only those are verified, by alignment within the band.

Items are read in blocks of bounded size; each block is sent to all tasks and meets every document.
So memory doesn't depend on the number of items, and nothing is sampled or left out.

Contract of the results:

* Texts are compared as normalised characters: A-Z lowered, every run of ASCII characters that are
  neither letters nor digits read as one blank, other bytes as they are; blanks at the ends go.
* A match is a stretch of ``min_chars`` normalised bytes of an item (or the whole item, if shorter)
  that a document holds within ``max_edits`` of its length, rounded down. Of longer passages some
  stretch begins or ends with an unchanged q-gram, which is where alignment starts. One row per document and
  item: ids, the place of the best stretch in the document (code points of its text), its edits, and
  the item's share of bytes that verified stretches cover.
* Long runs of one character and the like take time in proportion to the text: see ``_hits``.
* Items of fewer than ``q`` normalised bytes, null or empty texts match nothing. Repeated rows of one
  ``doc_id`` or ``item_id`` give one row: the one with fewest edits, then the first place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, stored
from indicora.llm.textbytes import BYTE_BASE, LOWER, NOT_WORD, U64, blocks, mixed, powers

NULL_ID = -(1 << 63)
Q = 8
_TABLE_BITS = 22
#: Pairs of equal q-grams held at a time; grams are crowded beyond so many pairs a byte.
HITS, CROWDED = 1 << 20, 1
_CANON = LOWER.copy()
_CANON[NOT_WORD] = 0x20


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of some texts, where each text begins, and each byte's place in the input."""
    low = _CANON[data]
    blank = low == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    keep[heads] = ~blank[heads]
    place = np.flatnonzero(keep)
    begins = np.searchsorted(place, offsets)
    # a blank that ends its text goes as well
    last = begins[1:][np.diff(begins) > 0] - 1
    tail = last[blank[place[last]]]
    if len(tail):
        place = np.delete(place, tail)
        begins = np.searchsorted(place, offsets)
    return low[place], begins, place


def grams(data: np.ndarray) -> np.ndarray:
    """The ``Q`` bytes from each place on, as one number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, U64)
    return np.ndarray((n,), np.dtype("<u8"), np.ascontiguousarray(data), strides=(1,)).copy()


def _slot(g: np.ndarray) -> np.ndarray:
    return ((g * U64(0x9E3779B97F4A7C15)) >> U64(64 - _TABLE_BITS)).astype(np.int64)


@dataclass
class Items:
    """The q-grams of a block of items, sorted, and what matching each item takes."""

    ids: np.ndarray
    data: np.ndarray
    begins: np.ndarray
    least: np.ndarray  # L of each item
    edits: np.ndarray  # k
    shared: np.ndarray  # hits that the lemma asks for
    gram: np.ndarray
    at: np.ndarray  # place of each gram in data
    item: np.ndarray

    def known(self) -> np.ndarray:
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[_slot(self.gram)] = True
        return table


def indexed(ids: list[int], texts: list[str | None], min_chars: int, max_edits: float) -> Items:
    raw = [(t or "").encode() for t in texts]
    data, begins, _ = normalised(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    size = np.diff(begins)
    least = np.minimum(size, min_chars)
    edits = np.maximum(0, np.minimum((least * max_edits).astype(np.int64), (least - Q) // Q))
    g = grams(data)
    item = np.searchsorted(begins, np.arange(len(g)), "right") - 1
    inside = np.arange(len(g)) + Q <= begins[item + 1]
    at = np.flatnonzero(inside)
    order = np.argsort(g[at], kind="stable")
    at = at[order]
    return Items(np.array(ids, np.int64), data, begins, least, edits, least + 1 - Q * (edits + 1), g[at], at, item[at])


def _first_of_kind(doc: np.ndarray, begins: np.ndarray, owner: np.ndarray, place: np.ndarray, around: int) -> np.ndarray:
    """Places whose surroundings don't stand earlier in the same text; all near a text's ends.

    Alignments around two places with the same ``around`` bytes on both sides come out alike, and of
    equal ones the first place counts. Surroundings are compared by 64-bit hash.
    """
    up, down = powers(BYTE_BASE, len(doc) + 1)
    total = np.zeros(len(doc) + 1, U64)
    np.cumsum((doc.astype(U64) + U64(1)) * up[:-1], out=total[1:])
    text = owner[place]
    first = (place - around < begins[text]) | (place + around > begins[text + 1])
    inner = np.flatnonzero(~first)
    p = place[inner]
    kind = mixed((total[p + around] - total[p - around]) * down[p - around]) ^ mixed(text[inner].astype(U64))
    first[inner[np.unique(kind, return_index=True)[1]]] = True
    return first


def _hits(doc: np.ndarray, begins: np.ndarray, owner: np.ndarray, items: Items, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (place in the documents, number of the item's gram) of equal q-grams, and which of them
    may begin a stretch: all of them once, in slices of about ``HITS`` pairs that overlap by the
    length of a stretch. Where grams are crowded, as in long runs of one character, places that
    look like an earlier one begin none, and pairs out of reach of every beginning are left out.
    """
    g = grams(doc)
    place = np.flatnonzero(known[_slot(g)])
    place = place[place + Q <= begins[owner[place] + 1]]
    g = g[place]
    low, high = np.searchsorted(items.gram, g, "left"), np.searchsorted(items.gram, g, "right")
    place, low, n = place[high > low], low[high > low], (high - low)[high > low]
    if not len(place):
        return
    reach = int(items.least.max())
    leads = np.ones(len(place), bool)
    if n.sum() > CROWDED * len(doc):
        leads = _first_of_kind(doc, begins, owner, place, 3 * reach + 2 * int(items.edits.max()) + Q)
        before = np.maximum.accumulate(np.where(leads, np.arange(len(place)), -1))
        near = (before >= 0) & (place - place[np.maximum(before, 0)] <= reach)
        place, low, n, leads = place[near], low[near], n[near], leads[near]
    total = np.cumsum(n)
    at = 0
    while at < len(place):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + HITS, "right")))
        end = int(np.searchsorted(place, place[to - 1] + reach, "right"))
        own = n[at:end]
        which = np.repeat(low[at:end], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield np.repeat(place[at:end], own), which, np.repeat(leads[at:end] & (np.arange(at, end) < to), own)
        at = to


def banded_edits(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each row of ``a`` (n, L) and some stretch of the same row of ``b``.

    ``b`` (n, L + 2 width) holds what lies around: the stretch may begin in its first ``2 width + 1``
    places, and the alignment stays within the diagonals from there. Also the diagonal that it ends on.
    """
    n, length = a.shape
    band = 2 * width + 1
    steps = np.arange(band)
    row = np.zeros((n, band), np.int32)  # row[d]: edits with the next byte of b at place i + d
    for i in range(length):
        differs = b[:, i : i + band] != a[:, i, None]
        fresh = row + differs
        fresh[:, :-1] = np.minimum(fresh[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(fresh - steps, axis=1) + steps
    return row.min(axis=1), row.argmin(axis=1)


def _stretches(place: np.ndarray, which: np.ndarray, leads: np.ndarray, owner: np.ndarray, items: Items) -> tuple[np.ndarray, ...]:
    """Starts of dense stretches: (document, item, place in the document, place in the item)."""
    item = items.item[which]
    diagonal = place - items.at[which]
    wide = np.maximum(1, items.edits[item])  # a band is twice as wide, the next begins halfway
    found = []
    for shift in (0, 1):
        band = (diagonal + shift * wide) // (2 * wide)
        order = np.lexsort((place, band, item, owner[place]))
        p, w, t, b = place[order], which[order], item[order], band[order]
        d = owner[p]
        need = items.shared[t]
        ahead = np.arange(len(p)) + need - 1
        ok = leads[order] & (need > 0) & (ahead < len(p))
        ahead = np.minimum(ahead, max(0, len(p) - 1))
        ok &= (d[ahead] == d) & (t[ahead] == t) & (b[ahead] == b)
        ok &= p[ahead] - p <= items.least[t] - Q
        # the item's stretch begins at the first hit, or ends with the last of those counted
        last = items.at[w[ahead[ok]]] + Q - items.least[t[ok]]
        first = items.at[w[ok]]
        for begin in (first, np.clip(last, items.begins[t[ok]], first)):
            found.append(np.stack([d[ok], t[ok], p[ok] - (first - begin), begin], axis=1))
    return tuple(np.unique(np.concatenate(found), axis=0).T)


def _verify(doc: np.ndarray, begins: np.ndarray, starts: tuple[np.ndarray, ...], items: Items, best: dict[tuple[int, int], list]) -> None:
    """Keep, by document and item, the fewest edits, first and last place, and the bytes covered."""
    owner, item, p, j = starts
    for length in np.unique(items.least[item]):
        own = np.flatnonzero(items.least[item] == length)
        for a in range(0, len(own), 4096):
            at = own[a : a + 4096]
            t = item[at]
            width = int(items.edits[t].max()) * 2 + 1
            # moved inside the item
            j0 = np.minimum(j[at], items.begins[t + 1] - length)
            p0 = p[at] - (j[at] - j0)
            lane = np.arange(length)
            left = items.data[j0[:, None] + lane]
            spot = p0[:, None] - width + np.arange(length + 2 * width)
            inside = (spot >= begins[owner[at]][:, None]) & (spot < begins[owner[at] + 1][:, None])
            right = np.where(inside, doc[np.clip(spot, 0, len(doc) - 1)], 0)
            edits, ends = banded_edits(left, right, width)
            for i in np.flatnonzero(edits <= items.edits[t]).tolist():
                key = (int(owner[at[i]]), int(t[i]))
                lo, hi = max(int(begins[key[0]]), int(p0[i])), min(int(begins[key[0] + 1]), int(p0[i]) + int(length) + int(ends[i]) - width)
                entry = best.setdefault(key, [int(edits[i]), lo, hi, np.zeros(int(items.begins[key[1] + 1] - items.begins[key[1]]), bool)])
                if (int(edits[i]), lo) < (entry[0], entry[1]):
                    entry[:3] = [int(edits[i]), lo, hi]
                k = int(j0[i] - items.begins[key[1]])
                entry[3][k : k + length] = True


MATCHES = "doc_id long, item_id long, edits int, doc_start long, doc_end long, item_share double"


def _matches(shared):
    def run(batches: Batches) -> Batches:
        items: Items = shared.value
        known = items.known()
        for batch in batches:
            for slice_, data, offsets in blocks(batch):
                doc, begins, origin = normalised(data, offsets)
                owner = np.searchsorted(begins, np.arange(len(doc)), "right") - 1
                best: dict[tuple[int, int], list] = {}
                for place, which, leads in _hits(doc, begins, owner, items, known):
                    _verify(doc, begins, _stretches(place, which, leads, owner, items), items, best)
                if not best:
                    continue
                ids = slice_.column("__doc").to_pylist()
                rows = []
                for (d, t), (edits, lo, hi, covered) in best.items():
                    share = float(covered.mean())
                    text = data[offsets[d] : offsets[d + 1]]
                    chars = np.cumsum((text & 0xC0) != 0x80)
                    first, last = int(origin[lo] - offsets[d]), int(origin[max(lo, hi - 1)] - offsets[d])
                    rows.append((ids[d], int(items.ids[t]), edits, int(chars[first]) - 1, int(chars[last]), share))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], ["doc_id", "item_id", "edits", "doc_start", "doc_end", "item_share"])

    return run


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[int], list[str]]]:
    """The items in blocks of bounded size; they reach the driver a partition at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        if ids and size + len(row.text) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text)
    if ids:
        yield ids, texts


def matches(docs: DataFrame, benchmark: DataFrame, min_chars: int = 60, max_edits: float = 0.09, block_bytes: int = 1 << 21) -> DataFrame:
    """One row per document and item that it holds a stretch of."""
    spark = bounded_batches(docs).sparkSession
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__doc"), "text")
    out = None
    for ids, texts in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(indexed(ids, texts, min_chars, max_edits))
        part = stored(keyed.mapInArrow(_matches(shared), MATCHES), "matches")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], MATCHES)
    found = F.struct("edits", "doc_start", "doc_end")
    best = out.groupBy("doc_id", "item_id").agg(F.min(found).alias("m"), F.max("item_share").alias("item_share"))
    return best.select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "item_id", "m.edits", "m.doc_start", "m.doc_end", "item_share")


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without documents that hold a stretch of an item."""
    held = matches(docs, benchmark, **how).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__held")).distinct()
    return docs.join(held, F.coalesce(docs["doc_id"], F.lit(NULL_ID)) == F.col("__held"), "left_anti")
