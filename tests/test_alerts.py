import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from indicora import schemas, vocab
from indicora.operators import alerts
from indicora.scaling import count_before
from indicora.streaming import alert_flow

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _event(number, status="warning", minute=0, **cells):
    base = {
        "event_id": number, "event_type": "api_health", "source": "svc", "status": status,
        "message": "signal", "country": None, "metric": None, "value": None, "threshold": None,
        "observed_at": START + timedelta(minutes=minute), "metadata": {},
    }
    base.update(cells)
    return tuple(base[f.name] for f in schemas.OPS_EVENT)


def _frame(spark, rows):
    return spark.createDataFrame(rows, schemas.OPS_EVENT)


@pytest.mark.parametrize(
    "cells, expected",
    [
        (dict(status="failed", value=12.0, threshold=1.0), "critical"),
        (dict(status="degraded", value=850.0, threshold=500.0), "critical"),
        (dict(status="warning", value=550.0, threshold=500.0), "high"),
        (dict(status="info", value=1.0, threshold=0.0), "high"),
        (dict(status="info", value=0.0, threshold=0.0), "info"),
        (dict(status="error"), "high"),
        (dict(status="warning"), "medium"),
        (dict(status="info", event_type="climate_risk"), "medium"),
        (dict(status="recovered"), "info"),
        (dict(status="critical"), "critical"),
        (dict(status="unknown"), "low"),
    ],
)
def test_severity(spark, cells, expected):
    row = alerts.keyed(_frame(spark, [_event(1, **cells)])).first()
    assert row["severity"] == expected


def test_key_ignores_case_and_absent_scope(spark):
    rows = [_event(1, source="SVC", country=""), _event(2), _event(3, country="LAOS"), _event(4, country="Laos")]
    keys = [r["dedup_key"] for r in alerts.keyed(_frame(spark, rows)).orderBy("event_id").collect()]
    assert keys[0] == keys[1] != keys[2] == keys[3] and len(keys[0]) == 20


def test_same_event_twice_is_one_alert(spark):
    cells = dict(status="degraded", value=850.0, threshold=500.0)
    row = alerts.episodes(_frame(spark, [_event(1, **cells), _event(2, minute=1, **cells)])).collect()
    assert len(row) == 1 and row[0]["occurrences"] == 2 and row[0]["status"] == "open"


def _simulated(rows):
    """The lifecycle told one event after the other."""
    current, done = {}, []
    for r in sorted(rows, key=lambda r: (r[9], r[0])):
        key, resolves = r[2].lower(), r[3] in vocab.RESOLVING_STATUSES
        alert = current.setdefault(key, {"key": key, "first": r[0], "n": 0})
        alert.update(last=r[0], n=alert["n"] + 1, status="resolved" if resolves else "open")
        if resolves:
            done.append(current.pop(key))
    return sorted((a["key"], a["first"], a["last"], a["n"], a["status"]) for a in [*done, *current.values()])


def _random_events(size, seed):
    pick = random.Random(seed)
    rows = []
    for i in range(size):
        source = "hot" if pick.random() < 0.6 else f"svc{pick.randrange(5)}"
        status = pick.choice(["warning", "failed", "info", "recovered", "healthy"])
        rows.append(_event(i, status, minute=pick.randrange(300), source=source))
    return rows


def _told(segments):
    return sorted(
        (r["latest"]["source"], r["first"]["event_id"], r["last"]["event_id"], r["occurrences"],
         "resolved" if r["resolved"] else "open")
        for r in segments.collect()
    )


@pytest.mark.parametrize("seconds", [(600,), (3600, 60), (7200, 3600, 10)])
def test_segments_match_simulation(spark, seconds):
    rows = _random_events(600, seconds[0])
    found = _told(alerts.segments(alerts.keyed(_frame(spark, rows)), seconds))
    assert found == _simulated(rows)


def test_acknowledgement(spark):
    rows = [
        _event(1, minute=0), _event(2, minute=5),
        _event(3, minute=0, source="b"), _event(4, "recovered", minute=9, source="b"),
        _event(5, minute=0, source="c"),
    ]
    events = _frame(spark, rows)
    plain = alerts.episodes(events)
    acks = plain.select(
        "alert_id",
        F.lit("platform-team").alias("owner"),
        F.lit("looking").alias("note"),
        F.lit(START + timedelta(minutes=2)).alias("acknowledged_at"),
    ).where("source <> 'c'")
    got = {r["source"]: (r["status"], r["acknowledgement"]) for r in alerts.episodes(events, acks).collect()}
    assert got["svc"][0] == "acknowledged" and got["svc"][1]["owner"] == "platform-team"
    assert got["b"][0] == "resolved" and got["b"][1] is not None
    assert got["c"] == ("open", None)


def test_summary_and_list(spark):
    rows = [_event(1, "warning", event_type="climate_risk", country="Philippines")]
    found = alerts.episodes(_frame(spark, rows))
    row = alerts.summary(found).first()
    assert row["open_alerts"] == 1 and row["operational_state"] == "attention_required"
    assert row["severity_medium"] == 1 and row["severity_low"] == 0
    assert row["highest_open_severity"] == "medium"
    assert found.first()["title"] == "Climate-driven operational pressure: Philippines"
    assert alerts.listed(found, country="philippines", limit=3).count() == 1
    assert alerts.listed(found, country="laos").count() == 0
    assert alerts.summary(found.where("false")).first()["highest_open_severity"] == "none"


def test_root_cause(spark):
    rows = [_event(1, event_type="pipeline_failure", metadata={"dlq_count": "12", "other": "x"}, value=12.0),
            _event(2, event_type="mystery")]
    got = {r["event_id"]: r for r in alerts.root_causes(_frame(spark, rows)).collect()}
    assert got[1]["summary"] == "Pipeline delivery failure"
    assert "Dead-letter queue count: 12" in got[1]["evidence"] and len(got[1]["evidence"]) == 4
    assert [c["rank"] for c in got[1]["probable_causes"]] == [1, 2, 3]
    assert got[2]["summary"] == "API availability or latency incident"


def test_running_count_is_sliced(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), "id", (F.col("id") % 3 == 0).alias("hit"))
    got = count_before(df, ["k"], ["id"], F.col("hit"), [F.floor(F.col("id") / 200), F.floor(F.col("id") / 20)], "n")
    assert all(r["n"] == (r["id"] + 2) // 3 for r in got.collect())


def test_stream_equals_batch(spark, tmp_path):
    rows = sorted(_random_events(300, 7), key=lambda r: (r[9], r[0]))
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(4):
        piece = _frame(spark, rows[part * 75 : (part + 1) * 75])
        piece.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schemas.OPS_EVENT).parquet(source)
        alert_flow.start(stream, root, str(tmp_path / "progress")).awaitTermination()
    columns = ["alert_id", "dedup_key", "status", "occurrences", "severity", "created_at", "last_seen_at"]
    streamed = alert_flow.alert_table(spark, root).select(*columns)
    batch = alerts.episodes(_frame(spark, rows)).select(*columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # a batch that runs again after a crash replaces its own output
    last = _frame(spark, rows[225:])
    alert_flow.fold_batch(last, 3, root)
    again = alert_flow.alert_table(spark, root).select(*columns)
    assert again.exceptAll(batch).count() == 0 and batch.count() == again.count()


def test_windowed_errors_stream(spark, tmp_path):
    rows = [_event(i, "failed" if i % 4 == 0 else "info", minute=i) for i in range(60)]
    source = str(tmp_path / "in")
    _frame(spark, rows).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schemas.OPS_EVENT).parquet(source)
    rates = alert_flow.windowed_errors(stream, F.col("status") == "failed")
    flow = (
        rates.writeStream.format("memory").queryName("rates").outputMode("append")
        .trigger(availableNow=True).start()
    )
    flow.awaitTermination()
    got = spark.table("rates").orderBy("window_start").collect()
    assert got and got[0]["events"] == 5 and got[0]["alerting"]
