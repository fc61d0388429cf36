"""Isolation forest grown and applied by Spark tasks.

Each tree needs a random sample of at most 256 rows, so growing is one bounded group per tree;
scoring is a vectorised pass over the rows with the (bounded) forest broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicora.functions.numbers import rounded
from indicora.functions.quantiles import exact_quantiles
from indicora.learning.features import ANOMALY_FEATURES, calibrated, review_level
from indicora.session import scratch_path

TREES, SAMPLE, CONTAMINATION, SEED = 260, 256, 0.03, 42
#: Partitions whose samples meet in one round.
FAN = 16
_TREE = "tree int, split array<int>, cut array<double>, low array<int>, high array<int>, length array<double>"


def expected_length(rows: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``rows`` points."""
    n = np.asarray(rows, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    many = 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, many))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    nodes: dict[str, list] = {k: [] for k in ("split", "cut", "low", "high", "length")}

    def add(rows: np.ndarray, depth: int) -> int:
        here = len(nodes["split"])
        for name, start in (("split", -1), ("cut", 0.0), ("low", -1), ("high", -1)):
            nodes[name].append(start)
        nodes["length"].append(depth + float(expected_length(len(rows))))
        bottom, top = rows.min(axis=0), rows.max(axis=0)
        varied = np.flatnonzero(top > bottom)
        if depth >= limit or len(rows) < 2 or not len(varied):
            return here
        feature = int(rng.choice(varied))
        cut = float(rng.uniform(bottom[feature], top[feature]))
        under = rows[:, feature] <= cut
        if under.all():
            return here
        nodes["split"][here], nodes["cut"][here] = feature, cut
        nodes["low"][here] = add(rows[under], depth + 1)
        nodes["high"][here] = add(rows[~under], depth + 1)
        return here

    add(points, 0)
    return nodes


def _smallest(features: list[str], trees: int):
    """Of a partition, for each tree the ``SAMPLE`` rows whose draw is smallest."""
    def run(frames):
        best = [np.zeros((0, len(features)))] * trees
        hashes = [np.zeros(0, np.uint64)] * trees
        for frame in frames:
            h = frame["_h"].to_numpy().view(np.uint64)
            rows = frame[features].to_numpy(dtype=float)
            for tree in range(trees):
                draw = _draw(h, tree)
                near = np.argpartition(draw, SAMPLE)[:SAMPLE] if len(draw) > SAMPLE else np.arange(len(draw))
                draw = np.r_[_draw(hashes[tree], tree), draw[near]]
                order = np.argsort(draw, kind="stable")[:SAMPLE]
                hashes[tree] = np.r_[hashes[tree], h[near]][order]
                best[tree] = np.concatenate([best[tree], rows[near]])[order]
        for tree in range(trees):
            if len(hashes[tree]):
                out = pd.DataFrame(best[tree], columns=features)
                out.insert(0, "_slot", TaskContext.get().partitionId())
                out.insert(0, "_draw", (_draw(hashes[tree], tree) >> np.uint64(1)).astype(np.int64))
                out.insert(0, "tree", tree)
                yield out

    return run


def _draw(h: np.ndarray, tree: int) -> np.ndarray:
    """A tree's own order of the rows, from their hashes."""
    x = (h ^ np.uint64(tree + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _samples(frame: DataFrame, key: list[str], features: list[str], trees: int) -> DataFrame:
    """(tree, _draw, features...): per tree the ``SAMPLE`` rows with the smallest draw.

    The subsample per tree is the method's own setting. Every partition first keeps its own
    smallest, whatever the size of the input, so at most ``SAMPLE`` rows per tree and partition
    are stored and merged; draws follow from the key, so a retry repeats them.
    """
    hashed = frame.select(F.xxhash64(*key, F.lit(SEED)).alias("_h"), *[F.col(c).cast("double") for c in features])
    shape = ", ".join(["tree int", "_draw long", "_slot int", *[f"`{c}` double" for c in features]])
    path = scratch_path(frame.sparkSession, "tree-samples")
    hashed.mapInPandas(_smallest(features, trees), shape).write.parquet(path)
    return _merged(frame.sparkSession.read.schema(shape).parquet(path), features, trees)


def _merged(own: DataFrame, features: list[str], trees: int, fan: int = FAN) -> DataFrame:
    """The smallest draws of every tree from the smallest of every partition, in rounds.

    A round brings ``fan`` partitions' rows of a tree together and keeps the ``SAMPLE`` smallest, so no
    group ever holds more than ``fan`` times ``SAMPLE`` rows, however many partitions there were.
    """
    slots = (own.agg(F.max("_slot")).first()[0] or 0) + 1
    # a stated number of tasks keeps adaptive execution from folding all trees into one
    tasks = min(trees, own.sparkSession.sparkContext.defaultParallelism * 2)
    while True:
        slots = -(-slots // fan)
        own = own.withColumn("_slot", F.floor(F.col("_slot") / fan).cast("int")).repartition(max(tasks, min(slots, 1000)), "tree", "_slot")
        ranked = Window.partitionBy("tree", "_slot").orderBy("_draw", *features)
        own = own.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= SAMPLE)
        if slots <= 1:
            return own.select("tree", "_rank", *features)


@dataclass
class IsolationModel:
    trees: list[dict[str, np.ndarray]]
    sample: int
    features: list[str]
    cut: float = 0.0
    q05: float = 0.0
    q50: float = 0.0
    q95: float = 1.0

    def raw_scores(self, df: DataFrame) -> DataFrame:
        """Add ``isolation_score`` in (0, 1); higher is stranger."""
        shared = df.sparkSession.sparkContext.broadcast(self.trees)
        norm = float(expected_length(self.sample)) * len(self.trees)

        @F.pandas_udf("double")
        def isolation(*columns: pd.Series) -> pd.Series:
            points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            total = np.zeros(len(points))
            rows = np.arange(len(points))
            for tree in shared.value:
                at = np.zeros(len(points), dtype=np.int64)
                while True:
                    feature = tree["split"][at]
                    inner = feature >= 0
                    if not inner.any():
                        break
                    value = points[rows, np.where(inner, feature, 0)]
                    step = np.where(value <= tree["cut"][at], tree["low"][at], tree["high"][at])
                    at = np.where(inner, step, at)
                total += tree["length"][at]
            return pd.Series(np.power(2.0, -total / norm))

        return df.withColumn("isolation_score", isolation(*[F.col(c) for c in self.features]))

    def scored(self, df: DataFrame) -> DataFrame:
        """Add decision, flag, calibrated score and review level."""
        raw = F.col("isolation_score") - F.lit(self.cut)
        flagged = raw > 0
        score = calibrated(raw, F.lit(self.q05), F.lit(self.q95))
        return (
            self.raw_scores(df)
            .withColumn("decision_function", rounded(-raw, 6))
            .withColumn("is_anomaly", flagged)
            .withColumn("anomaly_score", rounded(score, 2))
            .withColumn("review_level", review_level(score, flagged))
        )


def fit(
    frame: DataFrame,
    key: list[str],
    features: list[str] = ANOMALY_FEATURES,
    trees: int = TREES,
    contamination: float = CONTAMINATION,
) -> IsolationModel:
    rows = frame.count()
    if rows == 0:
        raise ValueError("Not enough observations to train an anomaly model.")
    sample = min(SAMPLE, rows)
    limit = max(int(np.ceil(np.log2(max(sample, 2)))), 1)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        ordered = group.sort_values("_rank")[features].to_numpy(dtype=float)
        nodes = _grow(ordered, np.random.default_rng([SEED, tree]), limit)
        return pd.DataFrame([{"tree": tree, **nodes}])

    grown = _samples(frame, key, features, trees).groupBy("tree").applyInPandas(grow, _TREE)
    # at most `trees` rows of at most 2 * SAMPLE nodes each
    forest = [
        {
            name: np.asarray(row[name], dtype=float if name in ("cut", "length") else np.int64)
            for name in ("split", "cut", "low", "high", "length")
        }
        for row in sorted(grown.collect(), key=lambda r: r["tree"])
    ]
    model = IsolationModel(forest, sample, features)
    wanted = {"cut": 1 - contamination, "q05": 0.05, "q50": 0.5, "q95": 0.95}
    marks = exact_quantiles(model.raw_scores(frame), [], "isolation_score", wanted).first()
    model.cut = marks["cut"]
    model.q05, model.q50, model.q95 = (marks[q] - model.cut for q in ("q05", "q50", "q95"))
    if model.q95 <= model.q05:
        model.q95 = model.q05 + 1.0
    return model


def metrics(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("training_rows"),
        F.count_if(F.col("is_anomaly")).alias("flagged_rows"),
        rounded(F.avg(F.col("is_anomaly").cast("double")), 6).alias("flagged_rate"),
        rounded(F.avg("decision_function"), 6).alias("mean_decision_function"),
    )
