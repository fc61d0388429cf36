import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from indicora.learning import features, forest, histogram_forest, isolation, registry
from indicora.operators import series


@pytest.fixture(scope="module")
def annual(spark):
    rows = []
    for i, country in enumerate(["Philippines", "Indonesia", "Thailand"]):
        for year in range(2000, 2016):
            wave = 0.15 * math.sin(year + i)
            rows.append((country, "life_expectancy_rate", year, round(65 + 2 * i + 0.35 * (year - 2000) + wave, 4)))
            rows.append((country, "infant_mortality_rate", year, round(38 - 3 * i - 0.8 * (year - 2000) + wave, 4)))
    return spark.createDataFrame(rows, "country string, indicator string, year int, value double").cache()


def test_lags(spark):
    df = spark.createDataFrame([("c", "i", 2000 + k, float(v)) for k, v in enumerate([1, 4, 9, 16, 25])], "country string, indicator string, year int, value double")
    got = features.forecast_frame(df).orderBy("year").collect()
    assert [r["year"] for r in got] == [2002, 2003, 2004]
    assert got[0]["rolling_mean_3"] == 2.5 and got[0]["trend_delta"] == 3.0
    assert got[2]["rolling_mean_3"] == pytest.approx(np.mean([4, 9, 16]))
    assert got[2]["rolling_std_3"] == pytest.approx(np.std([4, 9, 16]))
    assert [r["held_out"] for r in got] == [False, False, True]


def test_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(5, 2, 40), rng.normal(5, 2, 40)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "value double, prediction double")
    got = features.error_metrics(df).first()
    assert got["mae"] == pytest.approx(np.abs(y - p).mean(), abs=1e-6)
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)
    assert got["smape_pct"] == pytest.approx((2 * np.abs(y - p) / (np.abs(y) + np.abs(p))).mean() * 100, abs=1e-6)


def test_isolation_forest(spark, annual):
    changes = features.with_changes(annual)
    statistics = features.indicator_statistics(changes)
    frame = features.anomaly_features(changes, statistics)
    model = isolation.fit(frame, ["country", "indicator", "year"], trees=60)
    row = isolation.metrics(model.scored(frame)).first()
    assert row["training_rows"] == 96 and row["flagged_rows"] == 3
    odd = spark.createDataFrame(
        [("Philippines", "infant_mortality_rate", 2016, 5000.0, 26.0), ("Philippines", "infant_mortality_rate", 2008, 31.0, None)],
        "country string, indicator string, year int, value double, previous_value double",
    )
    filled = features.with_previous(odd, annual)
    got = {r["year"]: r for r in model.scored(features.anomaly_features(filled, statistics)).collect()}
    assert got[2016]["is_anomaly"] and got[2016]["review_level"] == "high" and got[2016]["anomaly_score"] >= 75
    assert got[2008]["previous_value_source"] == "training_baseline"
    again = isolation.fit(frame.repartition(5), ["country", "indicator", "year"], trees=60)
    assert again.cut == pytest.approx(model.cut, abs=1e-12)


def test_samples_merged_in_rounds(spark, annual):
    """However the rows are partitioned and merged, a tree's sample is its smallest draws."""
    frame = features.anomaly_features(changes := features.with_changes(annual), features.indicator_statistics(changes))
    names = features.ANOMALY_FEATURES
    wanted = None
    for parts, fan in ((1, 16), (40, 3), (7, 2)):
        shape = ", ".join(["tree int", "_draw long", "_slot int", *[f"`{c}` double" for c in names]])
        hashed = frame.repartition(parts).select(F.xxhash64("country", "indicator", "year", F.lit(isolation.SEED)).alias("_h"), *[F.col(c).cast("double") for c in names])
        own = hashed.mapInPandas(isolation._smallest(names, 5), shape)
        got = sorted(map(tuple, isolation._merged(own, names, 5, fan).collect()))
        wanted = wanted or got
        assert len(got) == 5 * 96 and got == wanted


def _leaves(tree):
    return sorted(tree["value"][tree["low"] < 0].round(9).tolist())


def test_trees_split_by_level_equal_local_ones(spark):
    """Nodes split from summed histograms, and the same ones grown in a single task."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 30, (600, 3)).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 12) * 40 + rng.normal(0, 0.01, 600)
    rows = [(int(k), Vectors.dense(p), float(v)) for k, p, v in zip(range(600), x, y)]
    frame = spark.createDataFrame(rows, ["key", "features", "value"])
    whole = histogram_forest.fit(frame, 3, 6, 2, 1)
    levels = histogram_forest.fit(frame.repartition(4), 3, 6, 2, 1, local=40)
    assert [_leaves(t) for t in whole.trees] == [_leaves(t) for t in levels.trees]
    assert np.allclose(whole.importances, levels.importances, atol=1e-6) and whole.importances[2] < 0.01
    scored = levels.transform(frame).collect()
    assert all(abs(r["prediction"] - r["value"]) < 15 for r in scored)
    # by hand: the first split of every tree has the least squares of all
    for number, tree in enumerate(whole.trees):
        w = histogram_forest.weights(np.arange(600).astype(np.int64).view(np.uint64), number, 1)
        best = min(
            (sum((w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum() for m in (low & (w > 0), ~low & (w > 0))), f, c)
            for f in range(3) for c in range(29) for low in [x[:, f] <= c] if (low & (w > 0)).sum() >= 2 and (~low & (w > 0)).sum() >= 2
        )
        assert (tree["split"][0], tree["cut"][0]) == (best[1], best[2] + 0.5)


def test_leaves_at_the_depth_limit_send_no_rows(spark, monkeypatch):
    """A large node at the limit is a leaf; its value comes from the split above it."""
    rows = [(k, Vectors.dense([float(k % 40), float(k % 7)]), float(k % 40 >= 25) * 10 + k % 7) for k in range(2_000)]
    frame = spark.createDataFrame(rows, ["key", "features", "value"])
    whole = [histogram_forest.fit(frame, 2, depth, 2, 5) for depth in (0, 1, 2)]
    monkeypatch.setattr(histogram_forest, "_dealt", lambda *_: pytest.fail("rows sent") if any(t.open for t in _[0].values()) else lambda batches: iter(()))
    for depth, same in zip((0, 1, 2), whole):
        by_level = histogram_forest.fit(frame, 2, depth, 2, 5, local=100)
        assert [len(t["low"]) for t in by_level.trees] == [2 ** (depth + 1) - 1] * 2
        for a, b in zip(by_level.trees, same.trees):
            assert _leaves(a) == _leaves(b) and len(_leaves(a)) == 2**depth


def test_drift(spark, annual):
    baseline = features.indicator_statistics(features.with_changes(annual))
    details = features.drift_details(annual, baseline)
    assert features.drift_summary(details).first()["status"] == "stable"
    moved = annual.withColumn("value", F.col("value") + 100).unionByName(
        annual.limit(3).withColumn("indicator", F.lit("fresh"))
    )
    found = {r["indicator"]: r["status"] for r in features.drift_details(moved, baseline).collect()}
    assert found == {"life_expectancy_rate": "drift", "infant_mortality_rate": "drift", "fresh": "new_indicator"}


def test_training_run(spark, annual, tmp_path):
    run = registry.train_all(spark, annual, str(tmp_path), trees=12)
    entries = {r["kind"]: r for r in registry.newest(run.registry).collect()}
    assert set(entries) == {"forecast", "anomaly"}
    assert entries["forecast"]["rows"] == 96 and entries["forecast"]["metrics"]["test_rows"] == 6
    assert features.changed_since(annual.select("country", "indicator", "year", "value"), entries["forecast"]["digest"]).first()["changed"] is False
    history = series.recent_history(annual)
    got = forest.forecasts(run.forecaster, history, run.statistics, run.residuals, 3).collect()
    assert len(got) == 18 and min(r["year"] for r in got) == 2016
    assert all(r["lower"] <= r["upper"] and 0 <= r["predicted_value"] < 120 for r in got)
    mine = [r for r in got if r["country"] == "Philippines" and r["indicator"] == "life_expectancy_rate" and r["year"] == 2016]
    assert all(60 < r["predicted_value"] < 80 for r in mine)
    # the tree arrays give what the fitted model gives
    frame = features.forecast_frame(annual)
    trees = run.forecaster.node_arrays(spark)
    ready = run.forecaster.preparation.transform(frame)
    spread = forest._tree_values(spark.sparkContext.broadcast(trees))
    from pyspark.ml.functions import vector_to_array

    both = run.forecaster.forest.transform(ready).withColumn(
        "own", spread(vector_to_array("features"), F.lit(-1e9), F.lit(1e9))["mean"]
    )
    assert both.where(F.abs(F.col("own") - F.col("prediction")) > 1e-9).count() == 0
    assert run.forecaster.importances(spark).count() == 11
