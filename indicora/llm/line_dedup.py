"""Drop lines that an earlier document already holds.

Two Bloom filters find suspects. Hashes of lines go, packed and combined within each batch, to
segments of the hash space; a segment's task fills a filter of hashes seen once and one of hashes
seen twice. Only the second is kept, folded as small as its load allows. It is sent to all tasks:
its size is bounded by ``twice_bytes`` whatever the input, and a fuller filter only means more
suspects. Lines that it doesn't hold never move. Suspects alone are shuffled, by their whole key,
which confirms repeats exactly and chooses the first document.

Contract of the results:

* A line's key is the line without blanks (space, tab to carriage return) at both ends, A-Z lowered.
* A key of at least ``min_chars`` code points in at least two documents keeps its lines only in the
  document with the smallest id; within that document all of them stay, also repeated ones.
* Null or empty text: one empty line. A document may lose all lines; its text is then empty.
* Rows with one ``doc_id`` are one document and lose no lines to each other, whether they repeat one
  text or hold several; each loses its own lines (texts of one id are told apart by a 64-bit hash). A
  null id sorts before all others. Text comes back as a string, never null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, extended, lists, stored, with_columns

NULL_ID = -(1 << 63)
#: Bits of a segment's filters, and the bytes of text that a segment stands for.
SEGMENT_BITS = 1 << 23
SEGMENT_TEXT = 32 << 20
PROBES = 3


def line_keys(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """The key of each line; None for lines too short to count."""
    keys = [line.strip() for line in (text or b"").lower().split(b"\n")]
    return [k if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8", "replace")) >= min_chars) else None for k in keys]


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places of each hash in a filter. Fewer bits (a power of two) mean the same places, folded."""
    low, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(24)) | np.uint64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(segments)).astype(np.int32)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _packed_hashes(segments: int, min_chars: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column("__doc").to_pylist()
            seen: dict[int, set[int]] = {}
            for doc, text in zip(ids, _texts(batch)):
                seen.setdefault(doc, set()).update(xxhash.xxh3_64_intdigest(k) for k in line_keys(text, min_chars) if k is not None)
            flat = np.fromiter((h for s in seen.values() for h in s), np.uint64)
            hashes, times = np.unique(flat, return_counts=True)
            part = _segment(hashes, segments)
            order = np.argsort(part, kind="stable")
            hashes, times, part = hashes[order], times[order], part[order]
            cuts = np.searchsorted(part, np.arange(segments + 1))
            used = np.flatnonzero(np.diff(cuts))
            packs = [(hashes[a:b], times[a:b] > 1) for a, b in zip(cuts[used], cuts[used + 1])]
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(used, pa.int32()),
                "once": pa.array([h[~t].tobytes() for h, t in packs], pa.binary()),
                "twice": pa.array([h[t].tobytes() for h, t in packs], pa.binary()),
            })

    return run


def _filled(largest: int):
    """Streams a partition's packed hashes into the two filters of each of its segments."""

    def run(batches: Batches) -> Batches:
        filters: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for segment, once, twice in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))):
                first, second = filters.setdefault(segment, [np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)])
                at = _slots(np.frombuffer(once, np.uint64), SEGMENT_BITS)
                again = at[first[at].all(axis=1)]
                second[again.ravel()] = True
                first[at.ravel()] = True
                at = _slots(np.frombuffer(twice, np.uint64), SEGMENT_BITS)
                first[at.ravel()] = True
                second[at.ravel()] = True
        for segment, (_, second) in filters.items():
            bits = second
            while len(bits) > 64 and (len(bits) > largest or bits.mean() < 0.02):
                bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return run


def repeated_line_filter(docs: DataFrame, min_chars: int, twice_bytes: int) -> tuple[int, dict[int, bytes]]:
    """The filter of hashes seen in two documents, by segment: ``twice_bytes`` in all at most."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(1, min(math.ceil(size / SEGMENT_TEXT), twice_bytes // 8))
    largest = max(64, 1 << ((8 * twice_bytes // segments).bit_length() - 1))
    packed = docs.mapInArrow(_packed_hashes(segments, min_chars), "segment int, once binary, twice binary")
    filters = packed.repartition(segments, "segment").mapInArrow(_filled(largest), "segment int, bits binary")
    return segments, {r.segment: bytes(r.bits) for r in filters.toLocalIterator()}


def _suspects(shared, segments: int, min_chars: int):
    def run(batches: Batches) -> Batches:
        filters = {k: np.frombuffer(v, np.uint8) for k, v in shared.value.items()}
        for batch in batches:
            docs, rows, keys, places = [], [], [], []
            for doc, row, text in zip(batch.column("__doc").to_pylist(), batch.column("__row").to_pylist(), _texts(batch)):
                at: dict[bytes, list[int]] = {}
                for i, k in enumerate(line_keys(text, min_chars)):
                    if k is not None:
                        at.setdefault(k, []).append(i)
                docs += [doc] * len(at)
                rows += [row] * len(at)
                keys += at.keys()
                places += at.values()
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
            part = _segment(hashes, segments)
            held = np.zeros(len(keys), bool)
            for segment in np.unique(part):
                bits = filters.get(int(segment))
                if bits is not None:
                    mine = np.flatnonzero(part == segment)
                    at = _slots(hashes[mine], 8 * len(bits))
                    held[mine] = (bits[at >> 3] & (128 >> (at & 7))).all(axis=1)
            found = np.flatnonzero(held)
            ends = np.cumsum([0, *(len(places[i]) for i in found)])
            yield pa.RecordBatch.from_arrays([
                pa.array([docs[i] for i in found], pa.int64()),
                pa.array([rows[i] for i in found], pa.int64()),
                pa.array([keys[i] for i in found], pa.binary()),
                lists([p for i in found for p in places[i]], ends, pa.int32()),
            ], ["__doc", "__row", "line_key", "at"])

    return run


def _cut(counts: bool):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, at in zip(_texts(batch), batch.column("__at").to_pylist()):
                parts = (text or b"").split(b"\n")
                gone = set(at or ())
                texts.append(b"\n".join(p for i, p in enumerate(parts) if i not in gone) if gone else text or b"")
                lines.append(len(parts))
                dropped.append(len(gone))
            added = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            if counts:
                added |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield extended(batch.drop_columns(["__at", "__doc", "__row"]), **added)

    return run


def without_repeated_lines(docs: DataFrame, min_chars: int = 10, twice_bytes: int = 32 << 20, counts: bool = True) -> DataFrame:
    """The rows of ``docs`` with their texts cut, and with ``counts`` ``n_lines`` (before), ``n_dropped``."""
    spark = docs.sparkSession
    docs = docs.drop("__doc", "__row", "__at")
    names = {"__doc": F.coalesce("doc_id", F.lit(NULL_ID)), "__row": F.xxhash64("text")}
    keyed = bounded_batches(docs).withColumns(names).select("__doc", "__row", "text")
    segments, filters = repeated_line_filter(keyed.drop("__row"), min_chars, twice_bytes)
    shared = spark.sparkContext.broadcast(filters)
    suspects = stored(keyed.mapInArrow(_suspects(shared, segments, min_chars), "__doc long, __row long, line_key binary, at array<int>"), "line-suspects")
    repeats = suspects.groupBy("line_key").agg(F.min("__doc").alias("_first"), F.max("__doc").alias("_last")).where("_first < _last")
    # stored, so that both sides of the join are shuffled for it and a hot line's rows can be split
    repeats = stored(repeats.select("line_key", "_first"), "line-repeats")
    drops = (
        suspects.join(repeats, "line_key").where("__doc > _first")
        .groupBy("__doc", "__row").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("__at"))
    )
    rows = docs.withColumns(names).join(drops, ["__doc", "__row"], "left")
    added = {"n_lines": "bigint", "n_dropped": "bigint"} if counts else {}
    return rows.mapInArrow(_cut(counts), with_columns(docs.drop("text").schema, text="string", **added))
