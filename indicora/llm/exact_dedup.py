"""Find documents of equal text by content-defined chunk recipes.

Each text (A-Z lowered) is cut where a hash of the bytes just read says so, thus at the same places
in equal stretches of text. A chunk's identifier is the start of its SHA-256. Distinct chunks are
shuffled once, combined within each task first, to verify that no identifier stands for two
contents; if one does, identifiers are widened and verified again. Documents are then compared by
their recipe, the ordered list of identifiers, some eight bytes for two thousand of text: no text
of a document moves as a whole, and copies of one recipe are combined before the shuffle.

Contract of the results:

* Null text counts as empty; all empty texts are equal. Texts differ unless their bytes are
  identical after lowering A-Z.
* The row with the largest ``doc_id`` stays; a null id stays only if its whole group has null ids.
  Rows that repeat the id that stays are all kept: they are the same document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, stored
from indicora.llm.textbytes import BYTE_BASE, LOWER, blocks, mixed, powers

#: Bytes that decide about a cut, and the mean, least and largest length of a chunk.
WINDOW, MEAN, LEAST, MOST = 32, 2048, 512, 65536
WIDTHS = (8, 16, 32)


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text. They depend on the text's own bytes only."""
    n = len(data)
    up, down = powers(BYTE_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    hashes = mixed((total[WINDOW:] - total[:-WINDOW]) * down[: max(0, n - WINDOW + 1)]) if n >= WINDOW else total[:0]
    marks = np.flatnonzero((hashes & np.uint64(MEAN - 1)) == 0) + WINDOW
    firsts = np.searchsorted(marks, offsets)
    ends: list[list[int]] = []
    for t in range(len(offsets) - 1):
        at, stop, own = int(offsets[t]), int(offsets[t + 1]), []
        for mark in marks[firsts[t] : firsts[t + 1]].tolist():
            while mark - at > MOST:
                at += MOST
                own.append(at)
            if mark - at >= LEAST and mark < stop:
                own.append(at := mark)
        while stop - at > MOST:
            at += MOST
            own.append(at)
        ends.append([*own, stop] if stop > int(offsets[t]) else [])
    return ends


def _chunks(batch: pa.RecordBatch):
    """For each text of a batch: its row, its lowered bytes and its chunks."""
    row = 0
    for _, data, offsets in blocks(batch):
        low = LOWER[data]
        raw = low.tobytes()
        for t, ends in enumerate(chunk_ends(low, offsets)):
            starts = [int(offsets[t]), *ends[:-1]]
            yield row, raw[offsets[t] : offsets[t + 1]], [raw[a:b] for a, b in zip(starts, ends)]
            row += 1


def _recipes(width: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            recipes, shas = [], []
            for _, text, chunks in _chunks(batch):
                recipes.append(b"".join(hashlib.sha256(c).digest()[:width] for c in chunks))
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(recipes, pa.binary()), pa.array(shas, pa.string())], ["doc_id", "recipe", "text_sha256"])

    return run


def _contents(width: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = {c for _, _, chunks in _chunks(batch) for c in chunks}
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.sha256(c).digest()[:width] for c in found], pa.binary()),
                pa.array(found, pa.binary()),
            ], ["chunk_id", "content"])

    return run


def verified(docs: DataFrame, width: int) -> bool:
    """Whether every identifier of this width stands for one content."""
    contents = docs.select("text").mapInArrow(_contents(width), "chunk_id binary, content binary").distinct()
    return contents.groupBy("chunk_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0


def equal_texts(docs: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    bounded_batches(docs)
    for width in widths:
        if verified(docs, width):
            break
    else:
        raise ValueError("chunk identifiers of all widths stand for several contents")
    rows = stored(docs.select("doc_id", "text").mapInArrow(_recipes(width), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, recipe binary, text_sha256 string"), "recipes")
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # stored, so that both sides of the join are shuffled for it and a large group's rows can be split
    groups = stored(groups, "recipe-groups")
    return rows.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", (F.octet_length("recipe") / width).cast("int").alias("n_chunks"),
    )
