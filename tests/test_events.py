import json

import pytest
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions.scoring import retry_delay_seconds
from indicora.operators import contracts, events
from indicora.plans import views

GOOD = ("event-1", "TH-BKK-01", "Thailand", "2026-06-21T14:05:00Z", 34.2, 81.0, 12.4, 0)
SHAPE = (
    "event_id string, station_id string, country string, timestamp string, temperature_c double, "
    "humidity_pct double, rainfall_mm double, retry_count int, seq long"
)


def _frame(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SHAPE)


def _outcomes(df, **kw):
    routed = events.routed(df, contracts.sensor_event(), ["seq"], **kw)
    return {r["seq"]: r["outcome"] for r in routed.collect()}


def test_sent_twice(spark):
    assert _outcomes(_frame(spark, GOOD, GOOD)) == {0: "accepted", 1: "duplicate"}


def test_failures_go_to_retry_then_dlq(spark):
    no_country = (GOOD[0], GOOD[1], None, *GOOD[3:7])
    bad_station = ("event-2", "bad-station", "Thailand", GOOD[3], 30.0, 101.0, 1.0)
    df = _frame(spark, (*no_country, 5), (*no_country, 4), (*bad_station, 0), (*no_country, -1))
    assert _outcomes(df) == {0: "dlq", 1: "retry", 2: "retry", 3: "dlq"}
    marked = contracts.checked(df, contracts.sensor_event()).where("seq = 2").first()
    assert set(marked["broken_rules"]) == {"station_id_pattern", "humidity_pct_range"}


def test_ledger_blocks_known_fingerprints(spark):
    df = _frame(spark, GOOD)
    ledger = events.accepted(events.routed(df, contracts.sensor_event(), ["seq"]))
    assert _outcomes(df, accepted_before=ledger) == {0: "duplicate"}


def test_hot_fingerprint_has_no_group_task(spark):
    copies = spark.range(20_000).select(
        *[F.lit(v).alias(n) for n, v in zip(events.EVENT_COLUMNS, GOOD)],
        F.lit(0).alias("retry_count"),
        F.col("id").alias("seq"),
    )
    routed = events.routed(copies, contracts.sensor_event(), ["seq"])
    counted = dict(routed.groupBy("outcome").count().collect())
    assert counted == {"accepted": 1, "duplicate": 19_999}
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan


def test_retry_delays(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 4, 10, -1)], "n int")
    found = [r[0] for r in df.select(retry_delay_seconds(F.col("n"))).collect()]
    assert found == [5, 15, 45, 120, 300, 300, None]


def test_dead_letter_shape(spark):
    df = _frame(spark, (GOOD[0], GOOD[1], None, *GOOD[3:7], 5))
    rules = contracts.sensor_event()
    letter = events.dead_letters(
        events.routed(df, rules, ["seq"]), rules, F.current_timestamp()
    ).first()
    assert json.loads(letter["original_payload"])["event_id"] == "event-1"
    assert letter["error_message"] == "country is not supported"
    assert letter["retry_count"] == 5 and letter["source_topic"] == vocab.SOURCE_TOPIC


def test_correction_and_resolution(spark):
    df = _frame(spark, (GOOD[0], GOOD[1], "Atlantis", *GOOD[3:7], 5))
    rules = contracts.sensor_event()
    letters = events.dead_letters(
        events.routed(df, rules, ["seq"]), rules, F.current_timestamp()
    ).withColumns({"resolved_at": F.lit(None).cast("timestamp"), "resolution_notes": F.lit(None).cast("string")})
    fixes = letters.select(
        "original_payload", F.replace("original_payload", F.lit("Atlantis"), F.lit("Laos")).alias("new_payload")
    )
    again = events.corrected(letters, fixes, SHAPE.rsplit(",", 1)[0]).withColumn("seq", F.lit(0))
    assert _outcomes(again) == {0: "accepted"}
    done = events.resolved(letters, fixes, F.current_timestamp(), "fixed name").first()
    assert done["resolved_at"] is not None and done["resolution_notes"] == "fixed name"


def test_outcomes_add_up_and_ignore_row_order(spark, tiny):
    rows = views.sensor_replay(spark, tiny)
    rules = contracts.sensor_event(None)

    def run(df):
        return events.routed(df, rules, ["copy", "seq"]).select("copy", "seq", "outcome")

    plain = run(rows)
    mixed = run(rows.orderBy(F.xxhash64("seq", "copy")))
    assert plain.exceptAll(mixed).count() == 0
    row = events.outcome_counts(plain).first()
    assert row["input"] == sum(row[o] for o in vocab.OUTCOMES) == rows.count()


@pytest.mark.parametrize("strict, ok", [(True, False), (False, True)])
def test_scenario_profiles(spark, strict, ok):
    df = spark.createDataFrame(
        [("Laos", "dengue", 58.0, 100.0, 50.0)],
        "country string, disease string, temperature_c double, rainfall_mm double, humidity_pct double",
    )
    good, bad = contracts.split(df, contracts.scenario(strict=strict))
    assert (good.count() == 1) is ok and (bad.count() == 0) is ok


def test_extra_columns(spark):
    df = _frame(spark, GOOD)
    assert contracts.extra_columns(df, [*events.EVENT_COLUMNS, "retry_count"]) == ["seq"]
