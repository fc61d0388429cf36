import numpy as np
import pytest

from indicora.functions.quantiles import exact_quantiles


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_linear_interpolation(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {
        "wide": rng.normal(0, 1e6, 501),
        "narrow": 0.5 + rng.random(300) * 1e-6,
        "copies": np.repeat([0.0, -3.5, 7.25], [200, 50, 1]),
        "one": np.array([4.0]),
        "powers": np.array([2.0**k for k in range(-20, 20)]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("wide", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"a": 0.05, "b": 0.5, "c": 0.95, "lowest": 0.0, "highest": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", wanted).collect()}
    for g, values in groups.items():
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
    whole = exact_quantiles(df, [], "v", {"m": 0.37}).first()["m"]
    assert whole == pytest.approx(np.quantile(np.concatenate(list(groups.values())), 0.37), rel=1e-12)
