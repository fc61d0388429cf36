"""Turn texts into fill-in-the-middle examples, cut at exact ranks found in a skip list.

A text is a linked list of units (code points, words or lines). Express lanes lie over it: a node of
the lowest one spans ``NODE`` units, a node of each lane above ``FAN`` nodes of the lane below. Every
node carries its width in units, in code points and in bytes. To find a rank, walk right along the
top lane while the accumulated unit width does not pass the rank, go one lane down, and so on; the
last node's units are read from the text itself. The accumulated code-point and byte widths then
name the place exactly. A text is indexed in slices, so an index holds some bytes per ``NODE`` units.

Contract of the results:

* Null text counts as empty; empty texts, texts that hold a sentinel, and a share of all others
  drawn by the id stay plain: their output is the text itself, cut places are null.
* Cuts depend on ``seed`` and ``doc_id`` (null id: no digits) only, not on other rows. Rows that share
  an id and a length are cut alike; every row gives one row.
* Prefix, middle and suffix may each be empty. ``restored`` rebuilds the text of any row.
* Columns unknown here are carried along; ``output`` takes the place of ``text``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, extended, with_columns
from indicora.llm.textbytes import BLANK, blocks

#: Units below a node of the lowest express lane, and nodes below a node of the lanes above it.
NODE, FAN = 64, 16
SLICE = 1 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

Marks = Callable[[np.ndarray, int], np.ndarray]


def code_points(data: np.ndarray, before: int) -> np.ndarray:
    """Bytes that begin a code point."""
    return (data & 0xC0) != 0x80


def words(data: np.ndarray, before: int) -> np.ndarray:
    """Bytes that begin a word; the blanks after a word belong to it, blanks at the start are a unit."""
    blank = BLANK[data]
    after_blank = np.r_[before < 0 or bool(BLANK[before]), blank[:-1]] if len(data) else blank
    begins = ~blank & after_blank
    if len(data) and before < 0:
        begins[0] = True
    return begins


def lines(data: np.ndarray, before: int) -> np.ndarray:
    """Bytes that begin a line; its line feed belongs to it."""
    return np.r_[before in (-1, 0x0A), data[:-1] == 0x0A] if len(data) else np.zeros(0, bool)


UNITS: dict[str, Marks] = {"code_point": code_points, "word": words, "line": lines}


class SkipList:
    """Express lanes over the units of one text; ``lanes[k]`` has widths in units, code points, bytes."""

    def __init__(self, data: np.ndarray, marks: Marks = code_points):
        self.data, self.marks = data, marks
        places, points, units, seen = [], [], 0, 0
        for at in range(0, len(data), SLICE):
            part = data[at : at + SLICE]
            begins = np.flatnonzero(marks(part, int(data[at - 1]) if at else -1))
            own = begins[-units % NODE :: NODE]
            leads = code_points(part, 0)
            if marks is code_points:
                points.append(seen + np.arange(-units % NODE, len(begins), NODE))
            else:
                points.append(seen + np.cumsum(leads)[own] - 1)
            places.append(own + at)
            units += len(begins)
            seen += int(np.count_nonzero(leads))
        self.units, self.points = units, seen
        nodes = -(-units // NODE)
        width = np.full(nodes, NODE, np.int64)
        if nodes:
            width[-1] = units - NODE * (nodes - 1)
        where = lambda starts, end: np.diff(np.r_[np.concatenate(starts), end]) if nodes else width
        self.lanes = [(width, where(points, seen), where(places, len(data)))]
        while len(self.lanes[-1][0]) > FAN:
            firsts = np.arange(0, len(self.lanes[-1][0]), FAN)
            self.lanes.append(tuple(np.add.reduceat(w, firsts) for w in self.lanes[-1]))

    def place(self, rank: int) -> tuple[int, int]:
        """Code points and bytes before the unit of this rank; the number of units names the end."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        if rank == self.units:
            return self.points, len(self.data)
        node = units = points = at = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            width, point_width, byte_width = self.lanes[level]
            while units + width[node] <= rank:
                units += int(width[node])
                points += int(point_width[node])
                at += int(byte_width[node])
                node += 1
            if level:
                node *= FAN
        part = self.data[at : at + int(self.lanes[0][2][node])]
        inside = int(np.flatnonzero(self.marks(part, int(self.data[at - 1]) if at else -1))[rank - units])
        return points + int(np.count_nonzero(code_points(part[:inside], 0))), at + inside


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that belong to an id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def _transform(seed: int, plain_from: int, spm_below: int, unit: str, sentinels: tuple[str, str, str]):
    marks, (p, s, m) = UNITS[unit], (x.encode() for x in sentinels)

    def one(data: np.ndarray, text: bytes, doc_id) -> tuple:
        index = SkipList(data, marks)
        h1, h2, h3, h4 = draws(seed, doc_id)
        if not text or h3 % 100 >= plain_from or p in text or s in text or m in text:
            return index.units, "plain", None, None, None, None, text
        first, last = sorted((h1 % (index.units + 1), h2 % (index.units + 1)))
        (before, a), (upto, b) = index.place(first), index.place(last)
        parts = (s, text[b:], p, text[:a], m, text[a:b]) if h4 % 100 < spm_below else (p, text[:a], s, text[b:], m, text[a:b])
        return index.units, "spm" if h4 % 100 < spm_below else "psm", first, last - first, before, upto - before, b"".join(parts)

    def run(batches: Batches) -> Batches:
        kinds = (pa.int64(), pa.string()) + (pa.int64(),) * 4 + (pa.binary(),)
        names = ("n", "form", "prefix_units", "middle_units", "prefix_chars", "middle_chars", "output")
        for batch in batches:
            for part, data, offsets in blocks(batch, limit=4 << 20):
                rows = [
                    one(own := data[a:b], own.tobytes(), doc)
                    for a, b, doc in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column("doc_id").to_pylist())
                ]
                made = {n: pa.array(c, k) for n, c, k in zip(names, zip(*rows) if rows else [[]] * 7, kinds)}
                made["output"] = made["output"].cast(pa.string())
                yield extended(part.drop_columns(["text"]), **made)

    return run


def transformed(
    docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, unit: str = "code_point",
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """The rows of ``docs`` (doc_id long, text string) with ``output`` in place of their text.

    Adds n (units), form (plain, psm, spm), prefix_units, middle_units, prefix_chars, middle_chars and
    output. A draw of 0 to 99 of at least ``plain_from`` leaves a text plain; another below ``spm_below``
    puts the suffix first. Sentinels begin with a character that occurs nowhere else in them.
    """
    if any(x[1:].find(x[:1]) >= 0 or x[:1] != sentinels[0][:1] for x in sentinels) or len(set(sentinels)) < 3:
        raise ValueError("sentinels must differ, begin alike, and hold their first character once")
    schema = with_columns(
        docs.drop("text").schema, n="bigint", form="string", prefix_units="bigint", middle_units="bigint",
        prefix_chars="bigint", middle_chars="bigint", output="string",
    )
    return bounded_batches(docs).mapInArrow(_transform(seed, plain_from, spm_below, unit, sentinels), schema)


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text a row was made from. Prefix and suffix hold no sentinel, so the first of each counts."""
    whole = F.col(output)
    p, s, m = sentinels
    at = {x: F.instr(whole, x) for x in sentinels}
    between = lambda a, b: whole.substr(at[a] + F.lit(len(a)), at[b] - at[a] - F.lit(len(a)))
    middle = whole.substr(at[m] + F.lit(len(m)), F.char_length(whole))
    return (
        F.when(F.col(form) == "psm", F.concat(between(p, s), middle, between(s, m)))
        .when(F.col(form) == "spm", F.concat(between(p, m), middle, between(s, p)))
        .otherwise(whole)
    )
