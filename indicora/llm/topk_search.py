"""Exact top-k search by inner product, with block-at-a-time pruning.

Components become whole numbers. Every task cuts its rows, a document range, into blocks of ``BLOCK``
rows; within a segment of ``SEGMENT`` rows similar ones are brought next to each other first. Each
dimension is two terms, its positive and its negative side: a block keeps its largest and smallest
component per dimension, and its rows one after the other as forward index. A query's bound for a
block is the sum, over its own components, of the term maxima. Blocks are visited in falling order of
their bounds and scored whole through the forward index, until the bounds fall below the query's kth
score. Bounds and scores of many queries at a time are matrix products.

A query is first run over the segment it came from, which gives it a kth score to begin with. Then
queries and segments meet in cells: queries are dealt into rows and segments into
columns of cells, by hash, and each cell is one group of an equi-join. A cell's work grows with the
product of its sides while it moves their sum, and its size does not depend on the input. It returns at
most k candidates per query; those are ranked after a partial cut in each task.

Contract of the results:

* Rows whose vector is null or holds null, NaN or infinite components take no part. Shorter vectors
  count as if they went on with zeros.
* Candidates of a query are all rows but the query's own; rows that share its id stay candidates, and
  every query row has its own answer. Ties go to the smaller id, a null id first, then in any order.
* Scores are exact; those beyond the range of a long count as its end. Queries with fewer candidates
  than k return all. Empty tables, or no queries, give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, stored

BLOCK, SEGMENT = 128, 8192
#: Components in a segment at most, and on the two sides of a cell on average.
SEGMENT_SIZE, ROW_SIZE, COLUMN_SIZE = 1 << 22, 1 << 20, 1 << 21
#: Tasks that all cells are dealt to, at most; a task has its cells one after the other.
MOST_TASKS = 20_000
#: Bounds held at a time, and most candidates kept before they are cut to the best.
TILE, PENDING = 1 << 24, 1 << 20
#: Whole numbers below these are exact in single and double precision.
SINGLE, DOUBLE = 1 << 24, 1 << 53
LEAST, MOST = -(1 << 63), (1 << 63) - 1
NULL_ID = LEAST

PACKED = "segment long, n long, dims int, kind string, ids binary, vectors binary, q_n long, q_keys binary, q_ids binary, q_vectors binary, q_kth binary"
FOUND = "query_key long, query_id long, vec_id long, vec_key long, score long"


class Rows:
    """Vectors of whole numbers, their ids, and keys that name their rows."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, values: np.ndarray):
        self.ids, self.keys, self.values = ids, keys, values
        self.most = float(np.abs(values).max(initial=0))

    def __len__(self) -> int:
        return len(self.ids)

    def at(self, rows) -> Rows:
        return Rows(self.ids[rows], self.keys[rows], self.values[rows])


def widened(values: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(values.astype(np.float64, copy=False), ((0, 0), (0, dims - values.shape[1])))


def joined(parts: list[Rows]) -> Rows:
    dims = max(p.values.shape[1] for p in parts)
    return Rows(np.concatenate([p.ids for p in parts]), np.concatenate([p.keys for p in parts]), np.concatenate([widened(p.values, dims) for p in parts]))


class Best:
    """The k best candidates of each query so far, and the score that a further one must reach."""

    def __init__(self, k: int, kth: np.ndarray):
        self.k, self.kth = k, kth.copy()
        self.held = [np.zeros(0, np.int64)] * 4  # query, score, id, key; in order
        self.fresh: list[tuple] = []
        self.waiting = 0

    def add(self, *found: np.ndarray) -> None:
        self.fresh.append(found)
        self.waiting += len(found[0])
        if self.waiting > PENDING:
            self.cut()

    def cut(self) -> None:
        if not self.waiting:
            return
        query, score, ids, keys = (np.concatenate(c) for c in zip(self.held, *self.fresh))
        order = np.lexsort((keys, ids, ~score, query))
        rank = np.arange(len(order)) - np.searchsorted(query[order], query[order], "left")
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.held = [c[order] for c in (query, score, ids, keys)]
        full = rank == self.k - 1
        self.kth[self.held[0][full]] = np.maximum(self.kth[self.held[0][full]], self.held[1][full])
        self.fresh, self.waiting = [], 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two tables of huge whole numbers, cut to the range of a long."""
    whole = [[int(v) for v in row] for row in b.tolist()]
    out = [[min(max(sum(x * y for x, y in zip(row, other)), LEAST), MOST) for other in whole] for row in ([int(v) for v in r] for r in a.tolist())]
    return np.array(out, np.int64).reshape(len(a), len(b))


def search(queries: Rows, table: Rows, ends: np.ndarray, k: int, kth: np.ndarray) -> tuple[Best, int]:
    """The k best rows of ``table`` for each query, of those whose score is ``kth`` at least.

    ``ends``: where each block of the table ends. Also returns how many pairs were scored.
    """
    best, scored = Best(k, kth), 0
    if not len(queries) or not len(table):
        return best, scored
    dims = max(queries.values.shape[1], table.values.shape[1])
    q, v = widened(queries.values, dims), widened(table.values, dims)
    most = queries.most * table.most * dims
    exact = most < DOUBLE
    if most < SINGLE:
        q, v = q.astype(np.float32), v.astype(np.float32)
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    high, low = np.maximum.reduceat(v, starts), np.minimum.reduceat(v, starts)
    per = max(1, TILE // max(len(ends), 4 * BLOCK))
    for first in range(0, len(q), per):
        part = q[first : first + per]
        if exact:
            bound = np.maximum(part, 0) @ high.T + np.minimum(part, 0) @ low.T
        else:
            bound = np.full((len(part), len(ends)), np.inf)  # sums could be rounded: score all blocks
        order = np.argsort(-bound, axis=1, kind="stable")
        at, step = 0, 1
        while at < len(ends):
            blocks = order[:, at : at + step]
            alive, rank = np.nonzero(np.take_along_axis(bound, blocks, 1) >= best.kth[first : first + per, None])
            if not len(alive):
                break
            block = blocks[alive, rank]
            by_block = np.argsort(block, kind="stable")
            alive, block = alive[by_block] + first, block[by_block]
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                here, rows = alive[a:b], slice(starts[block[a]], ends[block[a]])
                score = q[here] @ v[rows].T if exact else products(q[here], v[rows])
                scored += score.size
                i, j = np.nonzero(score >= best.kth[here, None])
                other = queries.keys[here][i] != table.keys[rows][j]
                i, j = i[other], j[other]
                best.add(here[i], score[i, j].astype(np.int64), table.ids[rows][j], table.keys[rows][j])
            best.cut()
            at, step = at + step, 2 * step
    return best, scored


def near_order(values: np.ndarray) -> np.ndarray:
    """An order of rows that brings similar ones together: by the best of some of them, then by score."""
    n = len(values)
    with np.errstate(over="ignore", invalid="ignore"):
        single = values.astype(np.float32)
        score = np.nan_to_num(single @ single[:: max(1, n // max(1, n // BLOCK))].T)
    leader = score.argmax(axis=1)
    return np.lexsort((-score[np.arange(n), leader], leader))


def block_ends(n: int) -> np.ndarray:
    return np.r_[np.arange(BLOCK, n, BLOCK), n].astype(np.int64)


def whole_vectors(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, floored components and question marks of the rows that take part."""
    column = batch.column("__vector").cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - lengths])
    values = np.zeros((int(good.sum()), int(lengths[good].max(initial=0))))
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(flat[np.repeat(good, lengths)] * scale), -1e300, 1e300)
    values[np.arange(values.shape[1])[None, :] < lengths[good][:, None]] = whole
    ids, asks = (batch.column(c).to_numpy(zero_copy_only=False)[good] for c in ("__id", "__asks"))
    return ids, values, asks


def _packed(k: int, scale: float):
    """Segments of a task's rows, each with its queries and the kth scores found within it."""

    def made(number: int, ids: np.ndarray, values: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
        order = near_order(values)
        rows = Rows(ids[order], (number << 13) + np.arange(len(ids)), values[order])
        own = rows.at(np.flatnonzero(asks[order]))
        best, _ = search(own, rows, block_ends(len(rows)), k, np.full(len(own), LEAST))
        kind = "<i2" if rows.most < 1 << 15 else "<i4" if rows.most < 1 << 31 else "<f8"
        row = (
            number, len(rows), rows.values.shape[1], kind, rows.ids.tobytes(), rows.values.astype(kind).tobytes(),
            len(own), own.keys.tobytes(), own.ids.tobytes(), own.values.astype(kind).tobytes(), best.kth.tobytes(),
        )
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        fields = [c.split() for c in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], kinds[t]) for x, (_, t) in zip(row, fields)], [n for n, _ in fields])

    def run(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        waiting, dims = 0, 1
        for batch in batches:
            for at in range(0, len(batch), SEGMENT):
                held.append(whole_vectors(batch.slice(at, SEGMENT), scale))
                waiting += len(held[-1][0])
                dims = max(dims, held[-1][1].shape[1])
                while waiting >= (most := max(1, min(SEGMENT, SEGMENT_SIZE // dims))):
                    ids, values, asks = np.concatenate([h[0] for h in held]), np.concatenate([widened(h[1], dims) for h in held]), np.concatenate([h[2] for h in held])
                    yield made(number, ids[:most], values[:most], asks[:most])
                    held, waiting, number = [(ids[most:], values[most:], asks[most:])], len(ids) - most, number + 1
        if waiting:
            yield made(number, np.concatenate([h[0] for h in held]), np.concatenate([widened(h[1], dims) for h in held]), np.concatenate([h[2] for h in held]))

    return run


def _cell(k: int):
    """All queries of a cell over all its segments."""
    numbers = lambda cell: np.frombuffer(cell, np.int64)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 5
        if len(left) and len(right):
            packs, parts = left.to_pylist(), right.to_pylist()
            queries = joined([Rows(numbers(r["q_ids"]), numbers(r["q_keys"]), np.frombuffer(r["q_vectors"], r["kind"]).reshape(r["q_n"], r["dims"])) for r in packs])
            table = joined([Rows(numbers(r["ids"]), (r["segment"] << 13) + np.arange(r["n"]), np.frombuffer(r["vectors"], r["kind"]).reshape(r["n"], r["dims"])) for r in parts])
            before = np.cumsum([0, *(r["n"] for r in parts)])
            ends = np.concatenate([block_ends(r["n"]) + b for r, b in zip(parts, before)])
            query, score, ids, keys = search(queries, table, ends, k, np.concatenate([numbers(r["q_kth"]) for r in packs]))[0].held
            found = [queries.keys[query], queries.ids[query], ids, keys, score]
        return pa.Table.from_arrays([pa.array(c) for c in found], [c.split()[0] for c in FOUND.split(", ")])

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 20, scale: float = 64.0, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per query its k best rows: query_id, rank (from 1), vec_id, score.

    ``asks`` marks the rows that are queries. Components count as floor(``scale`` * x). The id is a long,
    the vector an array of numbers.
    """
    rows = bounded_batches(vectors).select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID).cast("long")).alias("__id"),
        F.col(vector_column).alias("__vector"), F.coalesce(asks, F.lit(False)).alias("__asks"),
    )
    packs = stored(rows.mapInArrow(_packed(k, scale), PACKED), "vector-blocks")
    asked, all_ = packs.agg(F.sum(F.col("q_n") * F.col("dims")), F.sum(F.col("n") * F.greatest("dims", F.lit(1)))).first()
    down, across = max(1, -(-(asked or 0) // ROW_SIZE)), max(1, -(-(all_ or 0) // COLUMN_SIZE))
    dealt = lambda parts: F.pmod(F.xxhash64("segment"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    queries = packs.where("q_n > 0").select("kind", "dims", "q_n", "q_keys", "q_ids", "q_vectors", "q_kth", dealt(down).alias("down"), every(across).alias("across"))
    table = packs.select("segment", "n", "dims", "kind", "ids", "vectors", dealt(across).alias("across"), every(down).alias("down"))
    # a stated number of tasks: adaptive execution would fold cells by their bytes, but they are work
    tasks = min(down * across, MOST_TASKS)
    queries, table = (side.repartition(tasks, "down", "across") for side in (queries, table))
    found = queries.groupBy("down", "across").cogroup(table.groupBy("down", "across")).applyInArrow(_cell(k), FOUND)
    ids = lambda name: F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", "vec_key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(ids("query_id"), "rank", ids("vec_id"), "score")
