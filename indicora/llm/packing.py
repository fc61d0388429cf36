"""Pack token sequences into as few bins of a fixed size as best-fit finds.

Hierarchical residual packing: each partition packs its pieces best-fit, longest first, and emits
bins that are nearly full. The others go on as items of their own length, members and all, to fewer
tasks and are packed again, and so on up a tree. A round goes to as many tasks as ``items_per_task``
items each ask for, and a task packs so many at a time at most; rounds end when one task has packed
all that was left, or when a round hardly joins anything any more (say if every piece is over half a bin).

Contract of the results:

* A document's tokens are its text's ids (null: empty text) and one end id. Only documents of more
  than ``capacity`` tokens are cut, at multiples of it.
* Every piece lies in exactly one bin, bins are filled from offset 0 without gaps and never exceed
  ``capacity``. Repeated rows are packed as often as they occur. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from indicora.llm.common import Batches, bounded_batches, lists, stored
from indicora.llm.textbytes import blocks, span_hashes

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SEQUENCES = PIECES + ", sequence_id long, offset long"
BINS = "filled int, doc_ids array<bigint>, pieces array<int>, lengths array<int>, crcs array<bigint>"
END_ID = 1
NULL_ID = -(1 << 63)


#: Classes of characters by which the tokenizer splits words.
SPACE, LETTER, NUMBER, OTHER, STRANGE = range(5)
#: Latin characters end here; those below need two bytes at most.
LATIN_END = 0x250
_KINDS = {"L": LETTER, "N": NUMBER}


def _latin() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of every code point below ``LATIN_END``.

    Strange are control characters, blanks beyond the plain ones, and characters whose lower case
    is not one character of the same length in bytes: texts that hold them go to the tokenizer.
    """
    kinds, lower = np.full(LATIN_END, STRANGE, np.uint8), np.arange(LATIN_END)
    for code in range(LATIN_END):
        low = chr(code).lower()
        if chr(code) in " \t\n\r":
            kinds[code] = SPACE
        elif unicodedata.category(chr(code))[0] in "LNPS" and len(low) == 1 and ord(low) < LATIN_END and len(low.encode()) == len(chr(code).encode()):
            kinds[code] = _KINDS.get(unicodedata.category(low)[0], OTHER)
            lower[code] = ord(low)
    return kinds, lower


_KIND, _LOW = _latin()
#: Longer words are not remembered.
LONG_WORD = 256
APOSTROPHE = 0x27


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, starts, ends and texts of all words, and which texts are strange.

    A word is a run of letters, one number character, or a run of others; an apostrophe that stands
    alone before certain letters takes them along (the tokenizer's own rule).
    """
    n = len(data)
    low = data.copy()
    kind = np.full(n, STRANGE, np.uint8)
    plain = data < 0x80
    kind[plain] = _KIND[data[plain]]
    low[plain] = _LOW[data[plain]]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC9))
    lead = lead[lead + 1 < n]
    code = ((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
    inside = code < LATIN_END
    lead, code = lead[inside], code[inside]
    for at in (lead, lead + 1):
        kind[at] = _KIND[code]
    low[lead], low[lead + 1] = 0xC0 | (_LOW[code] >> 6), 0x80 | (_LOW[code] & 0x3F)
    follows = np.zeros(n, bool)
    follows[lead + 1] = True

    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.r_[np.uint8(SPACE), kind[:-1]] if n else kind
    begins = (kind != SPACE) & ~follows & (edge[:-1] | (before != kind) | (kind == NUMBER))
    _with_apostrophes(low, kind, edge, begins)
    used = kind != SPACE
    ends = used.copy()
    ends[:-1] &= ~used[1:] | begins[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    strange = np.zeros(len(offsets) - 1, bool)
    strange[np.searchsorted(offsets, np.flatnonzero(kind == STRANGE), "right") - 1] = True
    return low, start, end, text, strange


def _with_apostrophes(low: np.ndarray, kind: np.ndarray, edge: np.ndarray, begins: np.ndarray) -> None:
    """Let a word that is an apostrophe take the letters that belong to it."""
    n = len(low)
    at = np.flatnonzero((low == APOSTROPHE) & begins)
    for letters in _AFTER_APOSTROPHE:
        size = len(letters)
        own = at[at + size < n]
        hit = np.ones(len(own), bool)
        for k, letter in enumerate(letters, 1):
            hit &= (low[own + k] == ord(letter)) & ~edge[own + k]
        own = own[hit]
        begins[own + 1] = False
        next_ = own + size + 1
        next_ = next_[next_ < n]
        begins[next_[kind[next_] == LETTER]] = True


#: What an apostrophe takes along.
_AFTER_APOSTROPHE = ("s", "t", "re", "ve", "m", "ll", "d")


class WordIds:
    """Token ids of the words met so far, by a 64-bit hash of the word; those met lately are kept.

    Arrays sorted by hash: where a word's ids begin in ``pool``, how many they are, when it was met.
    """

    limit = 1_000_000

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.keys, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.count, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.now = 0
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        #: Added tokens stand for one id wherever they occur, whatever words they hold.
        self.added = re.compile("|".join(map(re.escape, added)).encode(), re.IGNORECASE) if added else None
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for piece, n in tokenizer.get_vocab().items():
            self.ends[n] = piece.endswith(WORD_END)

    def encoded(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        size = end - start + 1
        line = np.full(int(size.sum()), 0x20, np.uint8)
        to = np.cumsum(size) - size
        line[np.repeat(to, size - 1) + _within(size - 1)] = data[np.repeat(start, size - 1) + _within(size - 1)]
        raw, at = line.tobytes(), [*to[::256].tolist(), len(line)]
        lines = [raw[a:b].decode() for a, b in zip(at[:-1], at[1:])]
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
        cuts = np.r_[0, np.flatnonzero(self.ends[flat]) + 1]
        if len(cuts) == len(start) + 1 and cuts[-1] == len(flat):
            return flat, np.diff(cuts)
        own = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([raw[a : a + n - 1].decode() for a, n in zip(to.tolist(), size.tolist())], add_special_tokens=False)]
        return np.concatenate(own), np.array([len(i) for i in own])

    def places(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct words (in order of hash) begin in ``pool``, and how many they are."""
        self.now += 1
        at = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        new = self.keys[at] != hashes if len(self.keys) else np.ones(len(hashes), bool)
        if new.any():
            flat, count = self.encoded(data, start[new], end[new])
            if len(self.keys) + len(count) > self.limit:
                self._forget(hashes)
            where = np.searchsorted(self.keys, hashes[new])
            self.first = np.insert(self.first, where, len(self.pool) + np.cumsum(count) - count)
            self.count = np.insert(self.count, where, count)
            self.met = np.insert(self.met, where, self.now)
            self.keys = np.insert(self.keys, where, hashes[new])
            self.pool = np.concatenate([self.pool, flat])
            at = np.searchsorted(self.keys, hashes)
        self.met[at] = self.now
        return self.first[at], self.count[at]

    def _forget(self, needed: np.ndarray) -> None:
        """Keep the half met last, and those needed now."""
        kept = (self.met > np.median(self.met)) | np.isin(self.keys, needed)
        self.pool = self.pool[np.repeat(self.first[kept], self.count[kept]) + _within(self.count[kept])]
        self.keys, self.count, self.met = self.keys[kept], self.count[kept], self.met[kept]
        self.first = np.cumsum(self.count) - self.count


#: What the tokenizer's last piece of every word ends with.
WORD_END = "</w>"


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    return WordIds(Tokenizer.from_file(path))


def ids_of(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that lie end to end, each followed by the end id, and where each text's begin.

    The tokenizer splits words before it merges pairs, so a word's ids don't depend on its
    neighbours. Words of Latin texts are split here and distinct ones encoded once; texts with other
    characters or very long words, and those that quote an added token, go through the tokenizer whole.
    """
    known = word_ids(path)
    low, start, end, text, strange = words_of(data, offsets)
    strange[text[end - start > LONG_WORD]] = True
    raw = data.tobytes()
    for found in known.added.finditer(raw) if known.added and b"<|" in raw else ():
        strange[np.searchsorted(offsets, [found.start(), found.end() - 1], "right") - 1] = True
    plain = ~strange[text]
    start, end, text = start[plain], end[plain], text[plain]

    hashes, first, place = np.unique(span_hashes(low, start, end), return_index=True, return_inverse=True)
    begins, lengths = known.places(hashes, low, start[first], end[first])
    size = lengths[place]
    per_text = np.bincount(text, weights=size, minlength=len(strange)).astype(np.int64)
    whole = {t: np.array(known.tokenizer.encode(raw[offsets[t] : offsets[t + 1]].decode(), add_special_tokens=False).ids, "<u4") for t in np.flatnonzero(strange).tolist()}
    for t, own in whole.items():
        per_text[t] = len(own)
    where = np.cumsum(per_text + 1) - per_text - 1
    out = np.full(int((per_text + 1).sum()), END_ID, "<u4")
    # each word's ids go to its text's place, after those of the words before it
    ahead = np.cumsum(size) - size
    texts, firsts = np.unique(text, return_index=True)
    base = np.zeros(len(strange), np.int64)
    base[texts] = ahead[firsts]
    to = np.repeat(where[text] + ahead - base[text], size) + _within(size)
    out[to] = known.pool[np.repeat(begins[place], size) + _within(size)]
    for t, own in whole.items():
        out[where[t] : where[t] + len(own)] = own
    return out, np.r_[where, len(out)]


def token_ids(texts: list[str | None], path: str, group: int = 1 << 20) -> list[bytes]:
    """Ids of each text (null: empty) and the end id, as little-endian 32-bit numbers."""
    out = []
    for _, data, offsets in blocks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), limit=group):
        ids, at = ids_of(data, offsets, path)
        out += [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return out


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each of the runs of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _pieces(path: str, capacity: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for part, data, offsets in blocks(batch):
                ids, at = ids_of(data, offsets, path)
                raw = memoryview(ids.tobytes())
                for doc, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    for k, c in enumerate(range(a, b, capacity)):
                        d = min(b, c + capacity)
                        rows.append((doc, k, c - a, d - c, zlib.crc32(raw[4 * c : 4 * d])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest items first, each to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit r: some bin has room r
    sizes = lengths.tolist()
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[item]
        fits = free >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
            bins[b].append(item)
        else:
            r, b = capacity, len(bins)
            bins.append([item])
        if r > size:
            room[r - size].append(b)
            free |= 1 << (r - size)
    return bins


def _packed(capacity: int, items_per_task: int):
    """Best-fit over the items of a partition, at most so many at a time."""

    def out(filled, columns) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, columns[0])])
        flat = [np.concatenate(c) if len(c) else np.zeros(0, np.int64) for c in columns]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *(lists(f, ends, k) for f, k in zip(flat, kinds))], ["filled", "doc_ids", "pieces", "lengths", "crcs"])

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(batches).combine_chunks()
        sizes = whole.column("filled").to_numpy()
        arrays = [whole.column(c).combine_chunks() for c in ("doc_ids", "pieces", "lengths", "crcs")]
        starts = arrays[0].offsets.to_numpy()
        flat = [a.values.to_numpy(zero_copy_only=False) for a in arrays]
        filled, columns = [], [[], [], [], []]
        for members in best_fit(sizes, capacity):
            at = np.concatenate([np.arange(starts[m], starts[m + 1]) for m in members])
            filled.append(int(sizes[members].sum()))
            for column, values in zip(columns, flat):
                column.append(values[at])
        return out(filled, columns)

    def run(batches: Batches) -> Batches:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= items_per_task:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """Token pieces of every row: doc_id (``NULL_ID`` for null), piece, start, length, ids_crc32."""
    rows = bounded_batches(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text")
    return rows.mapInArrow(_pieces(tokenizer_path, capacity), PIECES)


def bins(parts: DataFrame, capacity: int = 4096, slack: float = 0.01, items_per_task: int = 200_000) -> DataFrame:
    """Pack pieces of at most ``capacity``: one row per bin, with its members in order.

    ``slack``: a bin whose room is at most this share counts as nearly full and is emitted.
    """
    items = parts.select(
        F.col("length").cast("int").alias("filled"), F.array("doc_id").alias("doc_ids"), F.array("piece").alias("pieces"),
        F.array(F.col("length").cast("int")).alias("lengths"), F.array("ids_crc32").alias("crcs"),
    )
    enough = int(capacity * (1 - slack))
    left = items.where(F.col("filled") < enough)
    done = items.where(F.col("filled") >= enough)
    tasks, before = None, None
    while True:
        packed = stored(left.mapInArrow(_packed(capacity, items_per_task), BINS), "bins")
        underfull = packed.where(F.col("filled") < enough)
        n = underfull.count()
        stuck = before is not None and n >= before * 0.98 and tasks > 1
        if n == 0 or tasks == 1 or stuck:
            return done.unionByName(packed)
        done = done.unionByName(packed.where(F.col("filled") >= enough))
        tasks = max(1, -(-n // items_per_task))
        left, before = underfull.repartition(tasks), n


def _members(capacity: int):
    """One row per member of a bin, with its place there."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ends = batch.column("lengths").offsets.to_numpy()
            ends = ends - ends[0]
            flat = {c: batch.column(c).flatten() for c in ("doc_ids", "pieces", "lengths", "crcs")}
            length = flat["lengths"].to_numpy().astype(np.int64)
            before = np.r_[0, np.cumsum(length)]
            n = np.diff(ends)
            ids = pc.if_else(pc.equal(flat["doc_ids"], NULL_ID), None, flat["doc_ids"])
            yield pa.RecordBatch.from_arrays([
                ids, flat["pieces"], pa.array(flat["pieces"].to_numpy().astype(np.int64) * capacity), pa.array(length), flat["crcs"],
                pa.array(np.repeat(batch.column("sequence_id").to_numpy(), n)), pa.array(before[:-1] - np.repeat(before[ends[:-1]], n)),
            ], [c.split()[0] for c in SEQUENCES.split(", ")])

    return run


def sequences(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = stored(pieces(docs, tokenizer_path, capacity), "pieces")
    packed = stored(bins(parts, capacity).withColumn("sequence_id", F.monotonically_increasing_id()), "sequences")
    return packed.mapInArrow(_members(capacity), SEQUENCES)
