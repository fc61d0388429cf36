"""Vectorised views of an Arrow text column: bytes, words, word hashes, window hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd multipliers of the two polynomial hashes, modulo 2**64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Everything below 0x80 that is neither a digit nor an ASCII letter.
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:0x80] = True
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; kept per process for the usual block size."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, (1 << 20) + 1)
        up = np.full(size, base, U64)
        down = np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        have = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        if size <= 1 << 21:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, end to end, and where each value begins (one offset more)."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch whose texts hold about ``limit`` bytes (one text at least), with their bytes."""
    data, offsets = buffers(batch.column(column))
    at, n = 0, len(batch)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of maximal runs of bytes that are not in ``apart``."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~apart[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: polynomial over the bytes, then mixed."""
    up, down = powers(BYTE_BASE, len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(U64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every ``width`` consecutive words, modulo 2**64."""
    n = len(words)
    if n < width:
        return np.zeros(0, U64)
    up, down = powers(WORD_BASE, n)
    total = np.zeros(n + 1, U64)
    np.cumsum(words * up, out=total[1:])
    return mixed((total[width:] - total[:-width]) * down[: n - width + 1])


def counts_per_text(doc: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(doc, minlength=texts).astype(np.int64)


def inside_text(doc: np.ndarray, width: int) -> np.ndarray:
    """Which windows of ``width`` consecutive words lie in one text."""
    n = len(doc)
    if n < width:
        return np.zeros(0, bool)
    return doc[: n - width + 1] == doc[width - 1 :]
