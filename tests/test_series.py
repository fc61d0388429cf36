import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicora import vocab
from indicora.operators import contracts, filters, profile, risk, series
from indicora.scaling import constant_table

LONG = "country string, year int, indicator string, sub_indicator string, sex string, value double"


def _random_rows(seed=3):
    pick = random.Random(seed)
    rows = []
    for country in ("Laos", "Vietnam", "Thailand", "Cambodia"):
        for indicator in ("tb_prevalence", "immunization_dpt", "unlisted", "hiv_prevalence"):
            subs = [None] if indicator != "tb_prevalence" else ["a", "b", None]
            for sub in subs:
                for year in range(2000, 2000 + pick.randrange(3, 9)):
                    rows.append((country, year, indicator, sub, None, round(pick.uniform(-5, 50), 2)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return _random_rows()


@pytest.fixture(scope="module")
def long(spark, rows):
    return spark.createDataFrame(rows, LONG)


def _newest_peer(rows):
    peers = {}
    for r in rows:
        rank = (r[1], r[3] is None, r[3] or "")
        key = (r[0], r[2])
        if key not in peers or rank > peers[key][0]:
            peers[key] = (rank, r[5])
    return {k: v[1] for k, v in peers.items()}


def test_latest(long, rows):
    got = {(r["country"], r["indicator"]): r["value"] for r in series.latest(long, series.SERIES).collect()}
    assert got == _newest_peer(rows)


def test_result_ignores_row_order(long):
    mixed = long.orderBy(F.rand(5)).repartition(7)
    for job in (lambda d: series.latest(d, series.SERIES), series.trends, series.annual_values):
        assert job(long).exceptAll(job(mixed)).count() == 0


def test_scores(spark, long, rows):
    directions = risk.direction_table(spark, "peer_score")
    known = vocab.DIRECTIONS["peer_score"]
    newest = {}
    for c, y, i, s, _, v in rows:
        if i in known and ((c, i, s) not in newest or y > newest[c, i, s][0]):
            newest[c, i, s] = (y, v)
    means, peers = {}, _newest_peer(rows)
    for (c, i, _), (_, v) in newest.items():
        means.setdefault((c, i), []).append(v)
    expected = {}
    for (c, i), values in means.items():
        spread = [v for (_, pi), v in peers.items() if pi == i]
        low, high = min(spread), max(spread)
        place = 0.5 if high == low else (np.mean(values) - low) / (high - low)
        place = place if known[i] > 0 else 1 - place
        expected.setdefault(c, []).append(round(max(0.0, min(100.0, place * 100)), 2))
    parts = risk.score_components(long, directions)
    for r in risk.scores(parts).collect():
        assert r["risk_score"] == pytest.approx(np.mean(expected[r["country"]]), abs=0.0051)
        assert 0 <= r["risk_score"] <= 100 and r["indicators_used"] == len(expected[r["country"]])
    drivers = risk.top_drivers(parts).where("country = 'Laos'").orderBy("driver_rank").collect()
    assert [d["risk_contribution"] for d in drivers] == sorted(expected["Laos"], reverse=True)[:3]


def test_equal_peers_and_comparative(spark):
    df = spark.createDataFrame(
        [("Laos", 2000, "tb_prevalence", None, None, 5.0), ("Vietnam", 2000, "tb_prevalence", None, None, 5.0),
         ("Laos", 2000, "hiv_prevalence", None, None, 1.0), ("Vietnam", 2000, "hiv_prevalence", None, None, 3.0)],
        LONG,
    )
    parts = risk.score_components(df, risk.direction_table(spark, "peer_score"))
    assert {r["risk_contribution"] for r in parts.where("indicator = 'tb_prevalence'").collect()} == {50.0}
    old = {r["country"]: r for r in risk.comparative_scores(df, risk.direction_table(spark, "comparative_score")).collect()}
    assert old["Vietnam"]["risk_score"] == 100.0 and old["Vietnam"]["risk_level"] == "high"
    assert old["Laos"]["indicators_used"] == 1


def test_wetter_is_riskier(spark):
    base = spark.createDataFrame([("Laos", 40.0)], "country string, risk_score double")
    scenarios = spark.createDataFrame(
        [("Laos", "dengue", 29.0, 10.0, 55.0), ("Laos", "dengue", 29.0, 180.0, 85.0), ("Laos", "mosquito_borne", 28.0, 120.0, 80.0)],
        "country string, disease string, temperature_c double, rainfall_mm double, humidity_pct double",
    )
    dry, wet, other = risk.disease_risk(scenarios, base).orderBy("rainfall_mm").collect()[0], None, None
    got = {r["rainfall_mm"]: r for r in risk.disease_risk(scenarios, base).collect()}
    assert got[180.0]["risk_score"] > got[10.0]["risk_score"] == dry["risk_score"]
    assert got[120.0]["disease"] == "Mosquito-borne disease"
    assert len(got[180.0]["weather_evidence"]) == 3 and len(got[10.0]["weather_evidence"]) == 1


def test_trend(spark):
    df = spark.createDataFrame(
        [("Laos", y, "x", None, None, v) for y, v in ((2000, 0.0), (2001, 9.0))]
        + [("Laos", y, "y", None, None, v) for y, v in ((2000, 100.0), (2005, 100.9))],
        LONG,
    )
    got = {r["indicator"]: r for r in series.trends(df).collect()}
    assert got["x"]["trend"] == "increasing" and got["x"]["percentage_change"] is None
    assert got["y"]["trend"] == "stable" and got["y"]["percentage_change"] == 0.9


def test_jumps(long, rows):
    by = {}
    for c, y, i, s, x, v in rows:
        by.setdefault((c, i, s), []).append((y, v))
    expected = set()
    for key, points in by.items():
        points.sort()
        change = np.diff([v for _, v in points])
        if len(points) < 4 or change.std() == 0:
            continue
        z = np.abs((change - change.mean()) / change.std())
        expected |= {(*key, points[k + 1][0]) for k in range(len(change)) if z[k] >= 1.2}
    got = series.yearly_jumps(long, 1.2).collect()
    assert {(r["country"], r["indicator"], r["sub_indicator"], r["year"]) for r in got} == expected
    with pytest.raises(ValueError):
        series.yearly_jumps(long, 0.5)


def test_line_forecast(spark):
    df = spark.createDataFrame(
        [("Laos", 2000 + k, "tb_prevalence", None, None, 3.0 * k + 1) for k in range(10)]
        + [("Laos", 2000 + k, "flat", None, None, 4.0) for k in range(4)]
        + [("Laos", 2000, "single", None, None, 4.0)],
        LONG,
    )
    got = series.line_forecasts(df, risk.direction_table(spark, "trend_forecast"), 2).orderBy("indicator", "year").collect()
    assert [(r["indicator"], r["year"], r["predicted_value"]) for r in got] == [
        ("flat", 2004, 4.0), ("flat", 2005, 4.0), ("tb_prevalence", 2010, 31.0), ("tb_prevalence", 2011, 34.0)
    ]
    assert (got[0]["trend"], got[0]["implication"], got[0]["confidence"], got[0]["r_squared"]) == ("stable", "neutral", "low", 1.0)
    assert (got[2]["trend"], got[2]["implication"], got[2]["confidence"]) == ("increasing", "worsening", "high")


def test_page_and_filters(long, rows):
    order = [F.col(c).asc_nulls_last() for c in ("country", "indicator", "year", "sub_indicator")]
    found = filters.page_with_total(filters.matching(long, country=" LAOS ", indicator=None), order, 2, 3).collect()
    mine = [r for r in rows if r[0] == "Laos"]
    assert len(found) == 3 and found[0]["total"] == len(mine)
    assert filters.matching(long, year=2001).count() == sum(r[1] == 2001 for r in rows)
    assert filters.first_records(long, 5).count() == 5


def test_validation_cases(spark):
    def report(rows, columns=LONG):
        return {r["rule"]: r for r in profile.validation_report(spark.createDataFrame(rows, columns), nulls_in=profile.REQUIRED).collect()}

    ok = ("Laos", 2000, "x", "s", "Male", 1.0)
    assert report([ok]) == {}
    assert report([ok, ("Laos", 2000, "x", "s", "Female", 1.0), ("Laos", 2000, "x", "t", "Male", 1.0)]) == {}
    assert report([ok, ok])["duplicates"]["detail"] == "Dataset contains 1 duplicate records."
    assert report([("Laos", 1800, "x", "s", None, 1.0)])["years"]["n"] == 1
    assert "Atlantis" in report([("Atlantis", 2000, "x", None, None, 1.0)])["countries"]["detail"]
    assert report([("Laos", 2000, "x", None, None, None)])["nulls"]["n"] == 1
    assert report([])["empty"]["severity"] == "error"
    with pytest.raises(ValueError):
        profile.validation_report(spark.createDataFrame([("a",)], "country string"))


def test_profile_and_readiness(spark, long):
    row = profile.quality_profile(long).first()
    assert row["status"] == "pass" and row["record_count"] == long.count()
    doubled = profile.quality_profile(long.union(long.limit(2))).first()
    assert doubled["duplicate_records"] == 4 and doubled["status"] == "warning"
    assert profile.readiness(profile.quality_profile(long.where("false"))).first()["status"] == "not_ready"
    contract = contracts.violation_counts(long, contracts.health_record())
    assert contract.count() == 0


def test_table_status(spark, long, tmp_path):
    path = str(tmp_path / "t")
    long.repartition(3).write.parquet(path)
    row = profile.table_status(spark.read.parquet(path)).first()
    assert row["records"] == long.count() and row["files"] == 3 and row["size_bytes"] > 0
    assert row["status"] == "ready" and 0 <= row["age_hours"] < 1


def test_names(spark):
    names = constant_table(spark, {"country": ["Laos", "Vietnam"]})
    asked = constant_table(spark, {"country": [" laos ", "VIETNAM", "Atlantis"]})
    known, unknown = series.with_names_of(asked, names, "country")
    assert {r[0] for r in known.collect()} == {"Laos", "Vietnam"}
    assert [r[0] for r in unknown.collect()] == ["Atlantis"]


def test_retention(spark):
    df = spark.createDataFrame(
        [(1, "2023-12-01", None), (2, "2022-12-01", None), (3, "2022-12-01", "2023-01-01")],
        "id int, failed string, resolved string",
    ).select("id", F.to_timestamp("failed").alias("failed_at"), F.to_timestamp("resolved").alias("resolved_at"))
    kept = df.where(filters.retained("dlq", F.to_timestamp(F.lit("2024-01-01"))))
    assert {r["id"] for r in kept.collect()} == {1, 2}
