"""Remove passages that stand earlier in the corpus.

Every window of ``width`` consecutive words gets a 64-bit Rabin-Karp hash. Tasks combine the windows
of some megabytes of text first: of equal ones only the earliest goes on, so a passage that a third
of all documents hold arrives once per block of text and not once per document. The survivors are
packed column by column (hashes, runs of ids, places), dealt by ranges of the hash, and each range
tells which windows have an earlier twin. The starts found are dealt by document, packed as well;
overlapping or adjoining windows merge into maximal intervals, and those are cut.

Contract of the results:

* Words are maximal runs without space, tab, line feed, vertical tab, form feed, carriage return;
  case counts. Kept words are joined by one space. Null or empty text has no words.
* A word goes if a window over it has the same words as one that starts earlier: in a document of
  smaller id, or earlier in the same one. Windows are judged on the input.
* Texts of fewer than ``width`` words stay whole. Rows with one ``doc_id`` are repeats of one
  document and don't count as earlier than each other. A null id comes before all others.
* Two different windows with one 64-bit hash would be taken as equal: of n windows, some n²/2⁶⁵ pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, extended, lists, with_columns
from indicora.llm.textbytes import U64, blocks, inside_text, span_hashes, window_hashes, word_spans

NULL_ID = -(1 << 63)
#: Bytes of text that a range of hashes stands for: some five million windows.
PART_TEXT = 32 << 20
#: Windows of one range of hashes, or, without hashes, starts to remove for one share of the ids:
#: ids, how many of the places belong to each, places.
PACKED = "part int, hashes binary, ids binary, runs binary, places binary"


def planes(values: np.ndarray) -> bytes:
    """The bytes of whole numbers, all lowest ones first: such columns compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unplaned(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packs(part: np.ndarray, ids: np.ndarray, place: np.ndarray, parts: int, hashes: np.ndarray | None = None) -> list[tuple]:
    """Windows packed by part; within each, rows keep their order."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    rows = []
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[p] : cuts[p + 1]]
        own = ids[at]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        runs = np.diff(np.r_[first, len(at)]).astype(np.int32)
        rows.append((p, hashes[at].tobytes() if hashes is not None else None, planes(own[first]), planes(runs), planes(place[at])))
    return rows


def _unpacked(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([np.repeat(unplaned(i, np.int64), unplaned(r, np.int32)) for *_, i, r, _ in rows])
    return ids, np.concatenate([unplaned(p, np.int32) for *_, p in rows])


def _removals(ids: np.ndarray, place: np.ndarray, parts: int) -> list[tuple]:
    order = np.lexsort((place, ids))
    return _packs(ids[order] % parts, ids[order], place[order], parts)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["part", "hashes", "ids", "runs", "places"])


def _windows(width: int, parts: int, most: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            n = 0
            for slice_, data, offsets in blocks(batch):
                ids = slice_.column("__doc").to_numpy()
                start, end, doc = word_spans(data, offsets)
                whole = np.flatnonzero(inside_text(doc, width))
                if len(whole):
                    own = doc[whole]
                    place = (whole - np.searchsorted(doc, own)).astype(np.int32)
                    gathered.append((window_hashes(span_hashes(data, start, end), width)[whole], ids[own], place))
                    n += len(whole)
                if n >= most:
                    yield _combined(*(np.concatenate(x) for x in zip(*gathered)), parts)
                    gathered, n = [], 0
            if gathered:
                yield _combined(*(np.concatenate(x) for x in zip(*gathered)), parts)

    return run


def _combined(hashes: np.ndarray, ids: np.ndarray, place: np.ndarray, parts: int) -> pa.RecordBatch:
    """Some windows: the starts of those with an earlier twin among them, and the others, packed."""
    later = _with_earlier_twin(hashes, ids, place)
    gone = _removals(ids[later], place[later], parts)
    stay = np.ones(len(hashes), bool)
    stay[later] = False
    hashes, ids, place = hashes[stay], ids[stay], place[stay]
    # ranges of the hash; each keeps its ids and places in the order of the text
    part = ((hashes >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
    return _batch([*_packs(part, ids, place, parts, hashes), *gone])


def _with_earlier_twin(hashes: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers of the windows that have a twin of smaller (id, place)."""
    order = np.argsort(hashes, kind="stable")
    same = np.diff(hashes[order]) == 0
    twins = order[np.r_[False, same] | np.r_[same, False]] if len(hashes) else order
    if not len(twins):
        return twins
    return twins[_later(hashes[twins], ids[twins], place[twins])]


def _later(hashes: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which of some windows have a twin of smaller (id, place)."""
    order = np.lexsort((place, ids, hashes))
    h, i, p = hashes[order], ids[order], place[order]
    first = np.maximum.accumulate(np.where(np.r_[True, h[1:] != h[:-1]], np.arange(len(h)), 0)) if len(h) else order
    out = np.zeros(len(h), bool)
    out[order] = (i != i[first]) | (p != p[first])
    return out


def _earlier_twins(parts: int):
    """Of one partition of ranges: the starts of windows that have an earlier twin."""

    def run(batches: Batches) -> Batches:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            known = batch.column("hashes").is_null()
            yield batch.filter(known)
            for row in zip(*(c.to_pylist() for c in batch.filter(pc.invert(known)).columns)):
                held.setdefault(row[0], []).append(row)
        while held:
            _, rows = held.popitem()
            ids, place = _unpacked(rows)
            gone = _with_earlier_twin(np.concatenate([np.frombuffer(h, U64) for _, h, *_ in rows]), ids, place)
            yield _batch(_removals(ids[gone], place[gone], parts))

    return run


def _intervals(width: int):
    """Of one partition of ids: maximal intervals of words to remove, by document."""

    def run(batches: Batches) -> Batches:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(row[0], []).append(row)
        while held:
            _, rows = held.popitem()
            ids, place = _unpacked(rows)
            order = np.lexsort((place, ids))
            ids, place = ids[order], place[order]
            fresh = np.r_[True, (ids[1:] != ids[:-1]) | (place[1:] > place[:-1] + width)]
            begin = np.flatnonzero(fresh)
            end = place[np.r_[begin[1:], len(place)] - 1] + width
            own = ids[begin]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            bounds = np.r_[first, len(own)]
            yield pa.RecordBatch.from_arrays([pa.array(own[first]), lists(place[begin], bounds), lists(end.astype(np.int32), bounds)], ["__doc", "__begins", "__ends"])

    return run


def _cut(batches: Batches) -> Batches:
    for batch in batches:
        texts, words, removed = [], [], []
        for text, begins, ends in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("__begins").to_pylist(), batch.column("__ends").to_pylist()):
            parts = (text or b"").split()
            kept, at = [], 0
            for a, b in zip(begins or (), ends or ()):
                kept += parts[at:a]
                at = b
            kept += parts[at:]
            texts.append(b" ".join(kept))
            words.append(len(parts))
            removed.append(len(parts) - len(kept))
        yield extended(batch.drop_columns(["__begins", "__ends", "__doc"]), text=pa.array(texts, pa.binary()).cast(pa.string()), n_words=pa.array(words, pa.int64()), n_removed=pa.array(removed, pa.int64()))


def without_repeated_passages(docs: DataFrame, width: int = 20, parts: int | None = None, most: int = 1 << 20) -> DataFrame:
    """The rows of ``docs`` with their texts cut, and ``n_words`` (before), ``n_removed``.

    ``parts``: ranges of hashes, each of which one task holds in memory at a time; unless given,
    one for every ``PART_TEXT`` bytes of text, and at least twice as many as the session has shuffle
    partitions. ``most``: windows a task combines at a time.
    """
    spark = bounded_batches(docs).sparkSession
    if not parts:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_TEXT))
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__doc"), "text")
    found = (
        keyed.mapInArrow(_windows(width, parts, most), PACKED)
        .repartition(parts, "part").mapInArrow(_earlier_twins(parts), PACKED).drop("hashes")
        .repartition(parts, "part").mapInArrow(_intervals(width), "__doc long, __begins array<int>, __ends array<int>")
    )
    rows = docs.withColumn("__doc", F.coalesce("doc_id", F.lit(NULL_ID))).join(found, "__doc", "left")
    return rows.mapInArrow(_cut, with_columns(docs.drop("text").schema, text="string", n_words="bigint", n_removed="bigint"))
