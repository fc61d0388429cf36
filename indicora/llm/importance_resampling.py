"""Draw the documents that look most like a target set, ranked by a distributed radix sort.

Texts become counts of hashed runs of words. A bucket's gain is the log ratio of its share among the
target texts and among all documents; a document's weight is the mean gain of its features; its score
adds noise drawn by its id (the Gumbel trick), so that the highest scores are a weighted draw without
replacement. Counts are arrays of fixed size, added up per task; scoring looks gains up in an array.

Scores are ranked by an LSD radix sort. Records carry their place. In every pass, from the last digit
of the composite key to the first, each chunk of records counts its digits; exclusive sums over
(digit, chunk) give each chunk its first destination per digit; the chunk's records, kept in order, are
dealt to the places that follow. After the last pass the place is the rank. A chunk never holds more
than ``CHUNK`` records, whatever the keys, so ties and hot keys make no task larger, and no task sees
more than one chunk. The driver sees one total per digit value (65,536 at most).

Contract of the results:

* Words are runs of digits, letters and bytes beyond ASCII, A-Z lowered; null and empty texts have none.
* Every row of ``docs`` gives one row. Rows of at least ``least_words`` words may be drawn. Ties go to
  the smaller ``doc_id`` (long), a null id before all others; rows equal in both stand in any order.
* A null id counts as empty text where noise is drawn. An empty table gives an empty result; without
  target texts all gains come from the documents alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, extended, stored, with_columns
from indicora.llm.textbytes import LOWER, NOT_WORD, blocks, word_spans

#: Most records of a chunk, and bits of a digit.
CHUNK_BITS, DIGIT_BITS = 20, 16
#: Words up to this many bytes are hashed side by side.
SHORT = 48
FULL = 0xFFFFFFFF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc_states(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 registers after each span, from the registers before it."""
    length = end - start
    order = np.argsort(-np.minimum(length, SHORT + 1), kind="stable")
    length, start, state = length[order], start[order], state[order]
    longer = int(np.searchsorted(-length, -SHORT, "left")) if len(length) else 0
    for k in range(longer):
        text = data[start[k] : start[k] + length[k]].tobytes()
        state[k] = zlib.crc32(text, int(state[k]) ^ FULL) ^ FULL
    active = np.searchsorted(-length[longer:], -np.arange(SHORT + 1), "left") + longer
    for j in range(SHORT):
        to = active[j]
        if to == longer:
            break
        part = state[longer:to]
        state[longer:to] = _TABLE[(part ^ data[start[longer:to] + j]) & 0xFF] ^ (part >> 8)
    out = np.empty_like(state)
    out[order] = state
    return out


def features(data: np.ndarray, offsets: np.ndarray, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every run of 1 to ``width`` words; words per text."""
    low = LOWER[data]
    start, end, doc = word_spans(low, offsets, NOT_WORD)
    state = crc_states(low, start, end, np.full(len(start), FULL, np.uint32))
    found, texts = [state], [doc]
    for n in range(2, width + 1):
        state = state[:-1]
        spaced = _TABLE[(state ^ 0x20) & 0xFF] ^ (state >> 8)
        state = crc_states(low, start[n - 1 :], end[n - 1 :], spaced)
        inside = doc[: len(state)] == doc[n - 1 :]
        found.append(state[inside])
        texts.append(doc[: len(state)][inside])
    flat = (np.concatenate(found) ^ np.uint32(FULL)) % np.uint32(buckets)
    return flat.astype(np.int64), np.concatenate(texts), np.bincount(doc, minlength=len(offsets) - 1)


def _count(buckets: int, width: int):
    def run(batches: Batches) -> Batches:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in blocks(batch):
                total += np.bincount(features(data, offsets, buckets, width)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return run


def counted(texts: DataFrame, buckets: int = 10_000, width: int = 2) -> np.ndarray:
    """Features per bucket over all texts: at most ``buckets`` rows from each task and to the driver."""
    rows = bounded_batches(texts).select("text").mapInArrow(_count(buckets, width), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    n, total, wanted = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (total + n)) / float((s + 1) * (wanted + n))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return math.floor(-1000 * math.log(-math.log((int.from_bytes(digest[:4], "big") + 0.5) / 4294967296)))


def _weigh(gain: np.ndarray, width: int, seed: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns: list[list] = [[], [], []]
            for part, data, offsets in blocks(batch):
                bucket, text, n_words = features(data, offsets, len(gain), width)
                n = np.bincount(text, minlength=len(part))
                # sums of whole numbers, exact in doubles
                total = np.bincount(text, weights=gain[bucket], minlength=len(part)).astype(np.int64)
                columns[0] += n_words.tolist()
                columns[1] += n.tolist()
                columns[2] += (total // np.maximum(n, 1)).tolist()
            scores = [w + noise(seed, d) for w, d in zip(columns[2], batch.column("doc_id").to_pylist())]
            made = zip(("n_words", "n_features", "weight", "score"), (*columns, scores))
            yield extended(batch.drop_columns(["text"]), **{k: pa.array(v, pa.int64()) for k, v in made})

    return run


def weighed(docs: DataFrame, gain: np.ndarray, width: int = 2, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` without their text, with n_words, n_features, weight and score."""
    schema = with_columns(docs.drop("text").schema, n_words="bigint", n_features="bigint", weight="bigint", score="bigint")
    return bounded_batches(docs).mapInArrow(_weigh(gain, width, seed), schema)


def _ordered(column: Column, descending: bool) -> Column:
    """A long whose bits, read as an unsigned number, sort like the column; null comes first."""
    least = F.lit(-(1 << 63)).cast("long")
    bits = F.coalesce(column.cast("long"), least).bitwiseXOR(least)
    return F.bitwise_not(bits) if descending else bits


def _digits(rows: DataFrame, keys: list[tuple[str, bool]], bits: int) -> Iterator[Column]:
    """Digits of the composite key, last first; leading bits that all records share are left out."""
    ends = rows.agg(*(f(F.coalesce(F.col(k).cast("long"), F.lit(-(1 << 63)).cast("long"))) for k, _ in keys for f in (F.min, F.max))).first()
    for n in reversed(range(len(keys))):
        low, high = ends[2 * n], ends[2 * n + 1]
        used = 0 if low is None else ((low ^ high) & ((1 << 64) - 1)).bit_length()
        ordered = _ordered(F.col(keys[n][0]), keys[n][1])
        passes = -(-used // bits)
        for p in range(passes):
            a, b = used * p // passes, used * (p + 1) // passes
            yield F.shiftrightunsigned(ordered, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).cast("int")


def _dealt(chunk_bits: int, start: np.ndarray):
    """Stable counting sort of one chunk: records in order of place, dealt to their destinations."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        place = left.column("__place").to_numpy() & ((1 << chunk_bits) - 1)
        in_order = np.empty(len(place), np.int64)
        in_order[place] = np.arange(len(place))
        digit = left.column("__digit").to_numpy()[in_order]
        counts = np.bincount(digit, minlength=len(start))
        by_digit = np.argsort(digit.astype(np.uint16), kind="stable")
        rank = np.empty(len(digit), np.int64)
        rank[by_digit] = np.arange(len(digit)) - np.repeat(np.cumsum(counts) - counts, counts)
        before = np.zeros(len(start), np.int64)
        before[right.column("__digit").to_numpy()] = right.column("__before").to_numpy()
        goes = np.empty(len(place), np.int64)
        goes[in_order] = start[digit] + before[digit] + rank
        kept = left.drop_columns(["__chunk", "__digit", "__place"])
        return kept.append_column("__place", pa.array(goes))

    return run


def radix_ranked(rows: DataFrame, keys: list[tuple[str, bool]], name: str = "rank", chunk_bits: int = CHUNK_BITS, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """``rows`` with their rank, from 1, by long columns ``keys``: (column, whether descending).

    Records travel once per digit; keep them short.
    """
    rows = stored(rows.withColumn("__place", F.monotonically_increasing_id()), "radix-records")
    schema = rows.schema
    digits = list(_digits(rows, keys, digit_bits)) or [F.lit(0)]
    for digit in digits:
        dealt = rows.withColumns({"__chunk": F.shiftright("__place", chunk_bits), "__digit": digit})
        counts = stored(dealt.groupBy("__chunk", "__digit").agg(F.count("*").alias("n")), "radix-counts")
        # at most 2 ** digit_bits totals; the sums over chunks are made where the digits lie
        start = np.zeros(1 << digit_bits, np.int64)
        for value, n in counts.groupBy("__digit").agg(F.sum("n")).collect():
            start[value] = n
        start = np.cumsum(start) - start
        before = counts.selectExpr("__chunk", "__digit", "sum(n) OVER (PARTITION BY __digit ORDER BY __chunk) - n AS __before")
        moved = dealt.groupBy("__chunk").cogroup(before.groupBy("__chunk")).applyInArrow(_dealt(chunk_bits, start), schema)
        rows = stored(moved, "radix-pass")
    return rows.withColumn(name, F.col("__place") + 1).drop("__place")


def resampled(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, buckets: int = 10_000, width: int = 2, seed: int = 7) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score and its rank among those drawn, else null.

    Draws floor(``share`` * N / 100) of the N rows of at least ``least_words`` words.
    """
    docs = docs.select("doc_id", "text")
    gain = gains(counted(docs, buckets, width), counted(target, buckets, width))
    rows = stored(weighed(docs, gain, width, seed), "weights")
    able = F.col("n_words") >= least_words
    wanted = rows.where(able).count() * share // 100
    ranked = radix_ranked(rows.where(able), [("score", True), ("doc_id", False)])
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return drawn.unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")))


def selected(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The documents drawn, whole, with their rank; rows that share an id come once for each rank."""
    return docs.drop("rank").join(ranks.where("rank IS NOT NULL").select("doc_id", "rank"), "doc_id")
