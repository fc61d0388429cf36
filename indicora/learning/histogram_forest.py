"""Regression forest grown from histograms of binned features.

Features are cut into at most ``BINS`` bins at quantiles and packed into two bytes each. A bootstrap
weight per row and tree follows from the row's key. Nodes of many rows are split level by level: tasks
add up, per node and feature, the rows and sums of every bin, the sums of all tasks meet per node and
feature, and the best split of each node comes back. A node of at most ``LOCAL`` rows is sent, rows and
all, to one task that grows the rest of its subtree; a node at the depth limit is a leaf whose value came
with the split above it, and its rows are not sent. So no task holds more than ``LOCAL`` rows of a node
or ``CELLS`` sums, and a small frame costs one shuffle instead of one per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BINS = 1024
#: Rows of a node that one task grows on, and bins of all histograms that are made in one job.
LOCAL, CELLS = 50_000, 1 << 22
#: Chances of a bootstrap weight of 0, 1, 2, ... at most (Poisson with mean 1).
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(12)])

_SUBTREE = "tree int, node int, low array<int>, high array<int>, split array<int>, bin array<int>, next array<int>, value array<double>, gain array<double>"
_SPLITS = "slot int, feature int, gain double, bin int, next int, rows_low double, rows_high double, value_low double, value_high double, value double"


def _bits(keys: np.ndarray, salt: int) -> np.ndarray:
    x = (keys ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def weights(keys: np.ndarray, tree: int, seed: int | None) -> np.ndarray:
    """How often each row is drawn for a tree; once without a seed."""
    if seed is None:
        return np.ones(len(keys), np.int64)
    unit = (_bits(_bits(keys, seed), tree + 1) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_POISSON, unit, "right")


def gains(n: np.ndarray, w: np.ndarray, s: np.ndarray, least: int) -> np.ndarray:
    """Gain of every split, from the rows, weights and sums up to it; the last row holds all."""
    ok = (n >= least) & (n[-1] - n >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s * s / w + (s[-1] - s) ** 2 / (w[-1] - w) - s[-1] * s[-1] / w[-1]
    return np.where(ok, gain, -np.inf)


def grown(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, limit: int, least: int) -> dict[str, list]:
    """The subtree over some rows, whose root lies at ``depth``."""
    nodes: dict[str, list] = {k: [] for k in ("low", "high", "split", "bin", "next", "value", "gain")}

    def add(at: np.ndarray, depth: int) -> int:
        here = len(nodes["low"])
        own_w, own_y = w[at], y[at]
        mean = float((own_w * own_y).sum() / own_w.sum())
        for name, start in (("low", -1), ("high", -1), ("split", -1), ("bin", -1), ("next", -1), ("value", mean), ("gain", 0.0)):
            nodes[name].append(start)
        if depth >= limit or len(at) < 2 * least or own_y.min() == own_y.max():
            return here
        own = bins[at]
        order = np.argsort(own, axis=0, kind="stable")
        own = np.take_along_axis(own, order, 0)
        n = np.broadcast_to(np.arange(1, len(at) + 1)[:, None], own.shape)
        gain = gains(n, np.cumsum(own_w[order], 0), np.cumsum((own_w * (own_y - mean))[order], 0), least)
        gain[:-1][own[:-1] == own[1:]] = -np.inf
        feature, row = divmod(int(gain.T.argmax()), len(at))
        if not gain[row, feature] > 0:
            return here
        cut, past = int(own[row, feature]), int(own[row + 1, feature])
        goes_low = bins[at, feature] <= cut
        nodes["split"][here], nodes["bin"][here], nodes["next"][here], nodes["gain"][here] = feature, cut, past, float(gain[row, feature])
        nodes["low"][here] = add(at[goes_low], depth + 1)
        nodes["high"][here] = add(at[~goes_low], depth + 1)
        return here

    add(np.arange(len(y)), depth)
    return nodes


class _Tree:
    """Splits found so far; ``open`` nodes wait for theirs."""

    def __init__(self, rows: int):
        self.low, self.high, self.split, self.bin, self.next, self.value, self.gain = ([x] for x in (-1, -1, -1, -1, -1, 0.0, 0.0))
        self.depth, self.rows = [0], [float(rows)]
        self.open = [0]

    def add(self, depth: int, rows: float, value: float) -> int:
        for column, x in zip((self.low, self.high, self.split, self.bin, self.next, self.value, self.gain, self.depth, self.rows), (-1, -1, -1, -1, -1, value, 0.0, depth, rows)):
            column.append(x)
        return len(self.low) - 1

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        low, high, split, cut = (np.array(c) for c in (self.low, self.high, self.split, self.bin))
        while True:
            inner = split[at] >= 0
            if not inner.any():
                return at
            goes_low = bins[rows, np.where(inner, split[at], 0)] <= cut[at]
            at = np.where(inner, np.where(goes_low, low[at], high[at]), at)


def _matrix(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), "<u2").reshape(-1, features)
    return bins, batch.column("value").to_numpy(), batch.column("key").to_numpy().view(np.uint64)


def _binned(edges: list[np.ndarray]):
    def run(batches):
        for batch in batches:
            column = batch.column("points")
            points = column.flatten().to_numpy().reshape(len(batch), -1) if len(batch) else np.zeros((0, len(edges)))
            bins = np.stack([np.searchsorted(e[:-1], points[:, f], "left") for f, e in enumerate(edges)], axis=1).astype("<u2")
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([r.tobytes() for r in bins], pa.binary()), batch.column("value")], ["key", "bins", "value"])

    return run


def _histograms(trees: dict[int, _Tree], slots: dict[tuple[int, int], int], first: np.ndarray, seed: int | None):
    """Rows, weights and sums of a task, per slot and feature."""

    def run(batches):
        total = np.zeros((3, len(slots), int(first[-1])))
        for batch in batches:
            bins, y, keys = _matrix(batch, len(first) - 1)
            flat = bins.astype(np.int64) + first[:-1]
            for number, tree in trees.items():
                place, w = tree.places(bins), weights(keys, number, seed)
                slot = np.full(len(tree.low), -1)
                for (t, node), k in slots.items():
                    if t == number:
                        slot[node] = k
                at = np.flatnonzero((slot[place] >= 0) & (w > 0))
                cells = (slot[place[at]][:, None] * int(first[-1]) + flat[at]).ravel()
                per = flat.shape[1]
                for part, x in zip(total, (np.ones(len(at)), w[at], w[at] * y[at])):
                    part += np.bincount(cells, np.repeat(x, per), part.size).reshape(part.shape)
        rows = [(k, f, total[:, k, first[f] : first[f + 1]].tobytes()) for k in range(len(slots)) for f in range(len(first) - 1) if total[0, k, first[f] : first[f + 1]].any()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int32(), pa.int32(), pa.binary()))], ["slot", "feature", "sums"])

    return run


def _split_of(least: int):
    """The best split of one node by one feature."""

    def run(part: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x, np.float64).reshape(3, -1) for x in part.column("sums").to_pylist())
        used = np.flatnonzero(sums[0])
        run = np.cumsum(sums[:, used], axis=1)
        gain = gains(*run, least)
        cut = int(gain.argmax())
        (n, w, s), (all_n, all_w, all_s) = run[:, cut], run[:, -1]
        ends = int(used[cut]), int(used[min(cut + 1, len(used) - 1)])
        high = (all_s - s) / (all_w - w) if all_w > w else all_s / all_w
        row = (part.column("slot")[0].as_py(), part.column("feature")[0].as_py(), float(gain[cut]), *ends, n, all_n - n, s / w, high, all_s / all_w)
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32()) + (pa.float64(),) * 5
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], [c.split()[0] for c in _SPLITS.split(", ")])

    return run


def _dealt(trees: dict[int, _Tree], features: int, seed: int | None):
    """Rows of open nodes, one for each tree that drew them."""

    def run(batches):
        for batch in batches:
            bins, y, keys = _matrix(batch, features)
            raw = batch.column("bins").to_pylist()
            for number, tree in trees.items():
                place, w = tree.places(bins), weights(keys, number, seed)
                waits = np.zeros(len(tree.low), bool)
                waits[tree.open] = True
                at = np.flatnonzero(waits[place] & (w > 0))
                if len(at):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), number, np.int32)), pa.array(place[at].astype(np.int32)), pa.array(np.array(tree.depth, np.int32)[place[at]]),
                        pa.array(w[at].astype(np.int32)), pa.array(y[at]), pa.array([raw[i] for i in at.tolist()], pa.binary()), pa.array(keys[at].view(np.int64)),
                    ], ["tree", "node", "depth", "weight", "value", "bins", "key"])

    return run


def _subtree(limit: int, least: int):
    def run(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        bins = np.frombuffer(b"".join(part.column("bins").to_pylist()), "<u2").reshape(len(part), -1)
        # sums don't depend on the order in which rows arrive
        order = np.lexsort((part.column("value").to_numpy(), part.column("key").to_numpy()))
        y, w = part.column("value").to_numpy()[order], part.column("weight").to_numpy()[order].astype(float)
        nodes = grown(bins[order], y, w, part.column("depth")[0].as_py(), limit, least)
        ints = pa.list_(pa.int32())
        kinds = (ints,) * 5 + (pa.list_(pa.float64()),) * 2
        head = [pa.array([part.column(c)[0].as_py()], pa.int32()) for c in ("tree", "node")]
        return pa.Table.from_arrays([*head, *(pa.array([nodes[n]], k) for n, k in zip(nodes, kinds))], ["tree", "node", *nodes])

    return run


@dataclass
class Forest:
    """Trees as arrays; their size is bounded by the number of trees and the depth."""

    trees: list[dict[str, np.ndarray]]
    importances: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the mean of all trees, from the vector column ``features``."""
        shared = df.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def mean(features: pd.Series) -> pd.Series:
            points = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1))
            rows, total = np.arange(len(points)), np.zeros(len(points))
            for tree in shared.value:
                at = np.zeros(len(points), np.int64)
                while len(points) and (inner := tree["low"][at] >= 0).any():
                    goes_low = points[rows, np.where(inner, tree["split"][at], 0)] <= tree["cut"][at]
                    at = np.where(inner, np.where(goes_low, tree["low"][at], tree["high"][at]), at)
                total += tree["value"][at]
            return pd.Series(total / len(shared.value))

        return df.withColumn("prediction", mean(vector_to_array("features")))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per tree."""
        shape = "tree int, low array<int>, high array<int>, split array<int>, cut array<double>, value array<double>"
        rows = [(i, *(t[c].tolist() for c in ("low", "high", "split", "cut", "value"))) for i, t in enumerate(self.trees)]
        return spark.createDataFrame(rows, shape)


def quantile_edges(rows: DataFrame, features: int, bins: int = BINS) -> list[np.ndarray]:
    """Per feature, the largest value of every bin; the driver gets bins times features numbers."""
    marks = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    cells = [F.percentile_approx(F.col("points")[f], marks, 20_000).alias(f"q{f}") for f in range(features)]
    ends = [F.max(F.col("points")[f]).alias(f"m{f}") for f in range(features)]
    row = rows.agg(*cells, *ends).first()
    return [np.array(sorted({*row[f"q{f}"], row[f"m{f}"]})) for f in range(features)]


def fit(ready: DataFrame, trees: int, depth: int, least: int, seed: int | None, local: int = LOCAL) -> Forest:
    """Grow a forest over ``ready``: features (vector), value, key (long, tells rows apart).

    Without a ``seed`` every tree learns from all rows.
    """
    rows = ready.select("key", vector_to_array("features").alias("points"), F.col("value").cast("double").alias("value"))
    features = rows.select(F.size("points")).first()[0]
    edges = quantile_edges(rows, features)
    first = np.cumsum([0, *map(len, edges)])
    binned = rows.mapInArrow(_binned(edges), "key long, bins binary, value double").persist()
    try:
        n = binned.count()
        grown_trees = {t: _Tree(n) for t in range(trees)}
        _split_large(binned, grown_trees, first, depth, least, seed, local)
        tasks = max(1, min(2 * ready.sparkSession.sparkContext.defaultParallelism, trees))
        waiting = binned.mapInArrow(_dealt(grown_trees, features, seed), "tree int, node int, depth int, weight int, value double, bins binary, key long")
        small = waiting.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInArrow(_subtree(depth, least), _SUBTREE)
        waits = any(tree.open for tree in grown_trees.values())
        for part in small.collect() if waits else []:  # trees of at most 2 ** depth nodes
            _graft(grown_trees[part["tree"]], part)
    finally:
        binned.unpersist()
    return _arrays(grown_trees, edges)


def _split_large(binned: DataFrame, trees: dict[int, _Tree], first: np.ndarray, depth: int, least: int, seed: int | None, local: int) -> None:
    """Split nodes of more than ``local`` rows, a level at a time. Those at the depth limit are leaves."""
    while large := [(t, n) for t, tree in trees.items() for n in tree.open if tree.rows[n] > local]:
        most = max(1, CELLS // int(first[-1]))
        for at in range(0, len(large), most):
            slots = {place: k for k, place in enumerate(large[at : at + most])}
            own = {t: trees[t] for t, _ in slots}
            sums = binned.mapInArrow(_histograms(own, slots, first, seed), "slot int, feature int, sums binary")
            splits = sums.groupBy("slot", "feature").applyInArrow(_split_of(least), _SPLITS)
            order = F.struct("gain", -F.col("feature"))  # of equal gains the first feature
            best = splits.groupBy("slot").agg(F.max_by(F.struct(*splits.columns[1:]), order).alias("b")).collect()
            found = {r["slot"]: r["b"] for r in best}
            for (t, node), k in slots.items():
                _split(trees[t], node, found.get(k), depth)


def _split(tree: _Tree, node: int, b, limit: int) -> None:
    tree.open.remove(node)
    if b is None or tree.depth[node] >= limit or not b["gain"] > 0:
        tree.value[node] = tree.value[node] if b is None or node else b["value"]
        return
    tree.split[node], tree.bin[node], tree.next[node], tree.gain[node] = b["feature"], b["bin"], b["next"], b["gain"]
    for side in ("low", "high"):
        child = tree.add(tree.depth[node] + 1, b[f"rows_{side}"], b[f"value_{side}"])
        getattr(tree, side)[node] = child
        if tree.depth[child] < limit:
            tree.open.append(child)


def _graft(tree: _Tree, part) -> None:
    """Put a subtree in the place of the node it was grown from."""
    base = len(tree.low) - 1  # the subtree's node k > 0 gets number base + k
    moved = lambda k: -1 if k < 0 else base + k
    node = part["node"]
    tree.low[node], tree.high[node] = moved(part["low"][0]), moved(part["high"][0])
    for name in ("split", "bin", "next", "value", "gain"):
        getattr(tree, name)[node] = part[name][0]
    for k in range(1, len(part["low"])):
        tree.add(0, 0.0, 0.0)
        tree.low[-1], tree.high[-1] = moved(part["low"][k]), moved(part["high"][k])
        for name in ("split", "bin", "next", "value", "gain"):
            getattr(tree, name)[-1] = part[name][k]


def _arrays(trees: dict[int, _Tree], edges: list[np.ndarray]) -> Forest:
    share = np.zeros(len(edges))
    out = []
    for _, tree in sorted(trees.items()):
        split = np.array(tree.split, np.int64)
        gain = np.bincount(split[split >= 0], np.array(tree.gain)[split >= 0], len(edges))
        share += gain / gain.sum() if gain.sum() > 0 else 0
        # halfway between the values on both sides
        cut = [(edges[f][a] + edges[f][b]) / 2 if f >= 0 else np.nan for f, a, b in zip(tree.split, tree.bin, tree.next)]
        out.append({
            "low": np.array(tree.low, np.int64), "high": np.array(tree.high, np.int64), "split": split, "cut": np.array(cut, float),
            "value": np.array(tree.value, float), "named": np.zeros(len(split), bool),
        })
    return Forest(out, share / share.sum() if share.sum() > 0 else share)
