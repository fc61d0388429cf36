"""Jaccard self-join on word shingles, with Bayesian pruning of candidates.

1. Every document gives a digest of its shingle set, the set's size and a MinHash signature. Of equal
   sets only the smallest document, the representative, goes on.
2. Bands of the signatures form buckets. Nothing is paired there: members of a bucket are tied to
   its smallest, first within a task's batch, so a bucket that holds a third of all rows sends on one
   member per batch. Ties join into candidate clusters (connected components).
3. The members of a cluster are split by set size, as sets that differ by more than the threshold in
   size can't be similar, and by hash into blocks of bounded size. Each pair of blocks is one cell,
   which compares its pairs' MinHash values piece by piece. A pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold, given the matches so far, is below
   ``tolerance``; the rest is verified on the whole sets. A cell sends on counts of links and a
   spanning forest of them, never its pairs.
4. Links join into groups; every document gets its group, its set and the set's links.

Contract of the results:

* Words are runs without blanks, A-Z lowered; a shingle is five words, or all words of a text of one
  to four. A link is a Jaccard similarity of ``threshold`` or more between two different sets.
* ``class_id``: smallest document of the connected group, ``set_id``: smallest with the same set,
  ``n_copies``: rows with that set, ``n_links``: other sets it is linked to, ``kept``: whether the
  document stands for its group.
* Texts without words (null, empty, blank) share one set without links. A null ``doc_id`` sorts
  before all others; repeats of a ``doc_id`` get a row each.
* Sets are compared by 64-bit shingle hashes. A pair at the threshold exactly is missed by the bands
  with a probability of some 5e-8, and dropped by pruning with one below ``tolerance`` per comparison.
"""

from __future__ import annotations

import hashlib
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicora.llm.common import Batches, bounded_batches, stored
from indicora.llm.substring_dedup import planes, unplaned
from indicora.llm.textbytes import LOWER, U64, blocks, mixed, span_hashes, window_hashes, word_spans

NULL_ID = -(1 << 63)
WIDTH = 5
HASHES, ROWS, STEP = 128, 4, 32
#: Members of one block of a cell.
BLOCK = 256

_seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_XOR, _ODD = _seeds[:HASHES], _seeds[HASHES:] | U64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each text's begin."""
    low = LOWER[data]
    start, end, doc = word_spans(low, offsets)
    words = span_hashes(low, start, end)
    n = len(offsets) - 1
    bounds = np.searchsorted(doc, np.arange(n + 1))
    windows = window_hashes(words, WIDTH)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= WIDTH:
            sets.append(np.unique(windows[a : b - WIDTH + 1]))
        else:
            sets.append(window_hashes(words[a:b], b - a) if b > a else words[:0])
    return np.concatenate([words[:0], *sets]), np.cumsum([0, *map(len, sets)])


def signatures(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values of each set; sets without members get the largest ones."""
    out = np.full((len(offsets) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat((((flat ^ _XOR[k]) * _ODD[k]) >> U64(32)).astype(np.uint32), offsets[some])
    return out


def _described(batches: Batches) -> Batches:
    for batch in batches:
        for slice_, data, offsets in blocks(batch):
            flat, ends = shingle_sets(data, offsets)
            sig = signatures(flat, ends)
            digests = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([
                slice_.column("__doc"), pa.array(digests, pa.binary()), pa.array(np.diff(ends), pa.int64()), pa.array([s.tobytes() for s in sig], pa.binary()),
            ], ["doc", "digest", "n", "sig"])


def _buckets(parts: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rep = batch.column("rep").to_numpy()
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(len(rep), HASHES)
            bands = sig.astype(U64).reshape(len(rep), HASHES // ROWS, ROWS)
            key = np.broadcast_to(np.arange(HASHES // ROWS, dtype=U64), bands.shape[:2])
            for r in range(ROWS):
                key = mixed(key * U64(0x9E3779B97F4A7C15) + bands[:, :, r])
            key, member = key.ravel(), np.repeat(rep, HASHES // ROWS)
            keys, least, a, b = _tied(key, member)
            part = (keys % U64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            used = np.flatnonzero(np.diff(cuts))
            rows = [order[x:y] for x, y in zip(cuts[used], cuts[used + 1])]
            none = [None] * len(a)
            yield pa.RecordBatch.from_arrays([
                pa.array([*used.tolist(), *(a % parts).tolist()], pa.int32()), pa.array([*(keys[o].tobytes() for o in rows), *none], pa.binary()),
                pa.array([*(planes(least[o]) for o in rows), *none], pa.binary()),
                pa.array([*[None] * len(rows), *a.tolist()], pa.int64()), pa.array([*[None] * len(rows), *b.tolist()], pa.int64()),
            ], ["part", "keys", "members", "a", "b"])

    return run


def _tied(key: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with their smallest member, and distinct ties of the others to it."""
    order = np.lexsort((member, key))
    k, m = key[order], member[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else order
    least = np.repeat(m[first], np.diff(np.r_[first, len(k)]))
    apart = m != least
    ties = np.unique(np.stack([m[apart], least[apart]], axis=1), axis=0)
    return k[first], m[first], ties[:, 0], ties[:, 1]


def _ties(batches: Batches) -> Batches:
    keys: dict[int, list] = {}
    for batch in batches:
        own = batch.filter(batch.column("keys").is_null())
        if len(own):
            yield own.select(["a", "b"])
        rest = batch.filter(batch.column("keys").is_valid())
        for part, k, m in zip(*(rest.column(c).to_pylist() for c in ("part", "keys", "members"))):
            keys.setdefault(part, []).append((k, m))
    while keys:
        _, rows = keys.popitem()
        _, _, a, b = _tied(np.concatenate([np.frombuffer(k, U64) for k, _ in rows]), np.concatenate([unplaned(m, np.int64) for _, m in rows]))
        for at in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 100_000]), pa.array(b[at : at + 100_000])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for all nodes of ``edges`` (a, b).

    Alternates large stars and small stars until neither changes an edge; each round is written to
    the shared folder, so lineage stays short.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every node now has only edges to smaller ones
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a")
        edges = stored(moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", "m")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of compared values: the fewest matches that keep a pair.

    With a uniform prior, the similarity's posterior after m matches of k is Beta(m + 1, k - m + 1);
    its mass above t is the probability of at most m successes in k + 1 trials of t.
    """
    out = {}
    for k in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out[k] = m
    return out


def _linked(sig: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool, threshold: float, needed: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that are similar enough."""
    size = np.array([len(s) for s in sets])
    keep = np.minimum(size[left][:, None], size[right]) >= threshold * np.maximum(size[left][:, None], size[right]) - 1e-9
    if same:
        keep &= np.arange(len(left))[:, None] < np.arange(len(right))
    i, j = np.nonzero(keep)
    i, j = left[i], right[j]
    matches = np.zeros(len(i), np.int32)
    for k in range(0, HASHES, STEP):
        for a in range(0, len(i), 1 << 15):
            matches[a : a + (1 << 15)] += (sig[i[a : a + (1 << 15)], k : k + STEP] == sig[j[a : a + (1 << 15)], k : k + STEP]).sum(axis=1, dtype=np.int32)
        stay = matches >= needed[k + STEP]
        i, j, matches = i[stay], j[stay], matches[stay]
    if not len(i):
        return i, j
    used = np.unique(np.r_[i, j])
    place = np.zeros(len(sets), np.int64)
    place[used] = np.arange(len(used))
    ends = np.cumsum([0, *(len(sets[u]) for u in used)])
    names, ids = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True)
    mark = np.zeros(len(names), bool)
    good = np.zeros(len(i), bool)
    firsts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    for a, b in zip(firsts, np.r_[firsts[1:], len(i)]):
        own = place[i[a]]
        mark[ids[ends[own] : ends[own + 1]]] = True
        if b - a > len(used) // 4:
            common = np.add.reduceat(mark[ids].astype(np.int32), ends[:-1])[place[j[a:b]]]
        else:
            common = np.array([np.count_nonzero(mark[ids[ends[o] : ends[o + 1]]]) for o in place[j[a:b]]])
        mark[ids[ends[own] : ends[own + 1]]] = False
        union = size[i[a]] + size[j[a:b]] - common
        good[a:b] = common >= threshold * union - 1e-9
    return i[good], j[good]


def _forest(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of some pairs."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


CELL = ["root", "ca", "sa", "cb", "sb"]


def _cells(threshold: float, tolerance: float):
    """Rows of a partition in order of cells: links of each member, and spanning links."""

    def solved(rows: list[tuple], needed: dict[int, int]) -> pa.RecordBatch:
        cell = rows[0][:5]
        reps = np.array([r[6] for r in rows])
        side = np.array([r[5] for r in rows])
        sig = np.frombuffer(b"".join(r[7] for r in rows), np.uint32).reshape(len(rows), HASHES)
        sets = [np.frombuffer(r[8], U64) for r in rows]
        same = cell[1:3] == cell[3:5]
        left = np.flatnonzero(side == 0)
        i, j = _linked(sig, sets, left, left if same else np.flatnonzero(side == 1), same, threshold, needed)
        degree = np.bincount(np.r_[i, j], minlength=len(rows))
        some = np.flatnonzero(degree)
        tree = _forest(i, j)
        return pa.RecordBatch.from_arrays([
            pa.array([*reps[some].tolist(), *(int(reps[a]) for a, _ in tree)], pa.int64()),
            pa.array([*[None] * len(some), *(int(reps[b]) for _, b in tree)], pa.int64()),
            pa.array([*degree[some].tolist(), *[0] * len(tree)], pa.int64()),
        ], ["a", "b", "links"])

    def run(batches: Batches) -> Batches:
        needed = least_matches(threshold, tolerance)
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*CELL, "side", "rep", "sig", "shingles"))):
                if held and held[0][:5] != row[:5]:
                    if len(held) > 1:
                        yield solved(held, needed)
                    held = []
                if not held or held[-1][5:7] != row[5:7]:  # repeats of a document's row
                    held.append(row)
        if len(held) > 1:
            yield solved(held, needed)

    return run


def _sets(batches: Batches) -> Batches:
    for batch in batches:
        for slice_, data, offsets in blocks(batch):
            flat, ends = shingle_sets(data, offsets)
            packed = pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*slice_.drop_columns(["text"]).columns, packed], [*slice_.drop_columns(["text"]).schema.names, "shingles"])


def _placed(members: DataFrame, threshold: float) -> DataFrame:
    """Members (rep, root, n) with their block and the numbers of blocks that they meet."""
    ratio = log(1 / threshold) * (1 + 1e-9)
    members = members.withColumn("c", F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int"))
    units = members.groupBy("root", "c").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    near = units.select("root", F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1)).alias("c"), F.col("c").alias("of"), "blocks")
    around = near.groupBy("root", "c").agg(
        F.coalesce(F.sum(F.when(F.col("of") == F.col("c"), F.col("blocks"))), F.lit(0)).alias("own"),
        F.coalesce(F.sum(F.when(F.col("of") == F.col("c") - 1, F.col("blocks"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("of") == F.col("c") + 1, F.col("blocks"))), F.lit(0)).alias("above"),
    )
    # stored, so that both sides of the join are shuffled for it and a large cluster's rows can be split
    around = stored(around.where("own > 0"), "cluster-blocks")
    return members.join(around, ["root", "c"]).withColumn("s", F.pmod(F.xxhash64("rep"), F.col("own")).cast("int"))


def _in_cells(placed: DataFrame) -> DataFrame:
    """Each member once for every cell that it takes part in."""
    others = """
        transform(sequence(0, cast(own as int) - 1), o -> named_struct('ca', c, 'sa', least(s, o), 'cb', c, 'sb', greatest(s, o), 'side', if(s <= o, 0, 1)))
    """
    above = "if(above = 0, array(), transform(sequence(0, cast(greatest(above, 1) as int) - 1), o -> named_struct('ca', c, 'sa', s, 'cb', c + 1, 'sb', o, 'side', 0)))"
    below = "if(below = 0, array(), transform(sequence(0, cast(greatest(below, 1) as int) - 1), o -> named_struct('ca', c - 1, 'sa', o, 'cb', c, 'sb', s, 'side', 1)))"
    return placed.select("root", "rep", "sig", "shingles", F.explode(F.expr(f"concat({others}, {above}, {below})")).alias("cell")).select("root", "cell.*", "rep", "sig", "shingles")


def joined(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6, parts: int | None = None) -> DataFrame:
    """Per row: doc_id, class_id, set_id, n_copies, n_links, kept."""
    spark = bounded_batches(docs).sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__doc"), "text")
    rows = stored(texts.mapInArrow(_described, "doc long, digest binary, n long, sig binary"), "shingle-rows")
    classes = stored(rows.groupBy("digest").agg(F.min("doc").alias("rep"), F.count("*").alias("n_copies"), F.min("n").alias("n"), F.any_value("sig").alias("sig")), "shingle-classes")
    ties = (
        classes.where("n > 0").select("rep", "sig")
        .mapInArrow(_buckets(parts), "part int, keys binary, members binary, a long, b long")
        .repartition(parts, "part").mapInArrow(_ties, "a long, b long")
    )
    clusters = components(ties)
    members = clusters.withColumnRenamed("node", "rep").join(classes.select("rep", "n", "sig"), "rep")
    placed = _placed(members, threshold)
    full = placed.join(texts, placed["rep"] == texts["__doc"]).drop("__doc")
    sets = full.mapInArrow(_sets, ", ".join(f"{n} {t}" for n, t in placed.dtypes) + ", shingles binary")
    solved = stored(
        _in_cells(sets).repartition(parts, *CELL).sortWithinPartitions(*CELL, "side", "rep")
        .mapInArrow(_cells(threshold, tolerance), "a long, b long, links long"), "links",
    )
    degree = solved.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("n_links"))
    groups = components(solved.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rep")
    known = stored(classes.select("digest", "rep", "n_copies").join(degree, "rep", "left").join(groups, "rep", "left"), "classes-known")
    shown = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    out = rows.select("doc", "digest").join(known, "digest").withColumn("root", F.coalesce("root", "rep"))
    return out.select(
        shown("doc").alias("doc_id"), shown("root").alias("class_id"), shown("rep").alias("set_id"), "n_copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col("doc") == F.col("root")).alias("kept"),
    )


def one_per_group(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group."""
    kept = joined(docs, **how).where("kept").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__kept")).distinct()
    return docs.join(kept, F.coalesce(docs["doc_id"], F.lit(NULL_ID)) == F.col("__kept"), "left_semi")
