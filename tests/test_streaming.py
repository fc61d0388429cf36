import json

from pyspark.sql import functions as F

from indicora import vocab
from indicora.sources import json_lines
from indicora.streaming import event_flow


def _line(number, **cells):
    base = {
        "event_id": f"event-{number}", "station_id": "TH-BKK-01", "country": "Thailand",
        "timestamp": f"2026-06-2{number % 5}T14:05:00Z", "temperature_c": 34.2,
        "humidity_pct": 81.0, "rainfall_mm": 12.4,
    }
    base.update(cells)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def _put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.jsonl").write_text("\n".join(lines) + "\n\n")


def _run(spark, tmp_path, progress="progress"):
    flow = event_flow.start(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / progress), files_per_batch=1
    )
    flow.awaitTermination()
    return event_flow.counts(spark, str(tmp_path / "out")).first().asDict()


def test_outcomes_over_several_batches(spark, tmp_path):
    incoming = tmp_path / "in"
    _put(incoming, "a", [_line(1), _line(2), _line(1), _line(3, temperature_c="30.5")])
    _put(incoming, "b", [_line(2), _line(4, country=None, retry_count=5), _line(5, humidity_pct=101)])
    got = _run(spark, tmp_path)
    assert {k: got[k] for k in ("input", *vocab.OUTCOMES)} == {
        "input": 7, "accepted": 3, "duplicate": 2, "retry": 1, "dlq": 1,
    }
    _put(incoming, "c", ["{broken", _line(6, extra=1), _line(3), "[1, 2]"])
    got = _run(spark, tmp_path)
    assert got["input"] == 11 and got["accepted"] == 3
    assert got["duplicate"] == 3 and got["dlq"] == 3 and got["retry"] == 2
    letters = event_flow.table(spark, str(tmp_path / "out"), "dlq")
    assert {r[0] for r in letters.select("original_payload").collect()} >= {"{broken", "[1, 2]"}


def test_rerun_of_a_batch_changes_nothing(spark, tmp_path):
    incoming = tmp_path / "in"
    _put(incoming, "a", [_line(1), _line(2)])
    root = str(tmp_path / "out")
    lines = json_lines.read_lines(spark, str(incoming))
    for _ in range(2):
        event_flow.route_batch(lines, 0, root, json_lines.line_rules())
    got = event_flow.counts(spark, root).first()
    assert (got["accepted"], got["duplicate"]) == (2, 0)
    event_flow.route_batch(lines, 1, root, json_lines.line_rules())
    got = event_flow.counts(spark, root).first()
    assert (got["accepted"], got["duplicate"]) == (2, 2)


def test_a_day_of_a_batch_is_one_file(spark, tmp_path):
    """Tasks don't each write a file for every day; what was known before is a duplicate all the same."""
    root = str(tmp_path / "out")
    _put(tmp_path / "in", "a", [_line(n % 300) for n in range(400)])
    lines = json_lines.read_lines(spark, str(tmp_path / "in"))
    for batch_id in (0, 1):
        event_flow.route_batch(lines, batch_id, root, json_lines.line_rules())
    got = event_flow.counts(spark, root).first()
    assert (got["accepted"], got["duplicate"]) == (300, 500)
    for name, batch_id in (("accepted", 0), ("duplicate", 0), ("duplicate", 1)):
        days = list((tmp_path / "out" / name / f"batch_id={batch_id}").glob("event_day=*"))
        assert len(days) == 5 and all(len(list(d.glob("*.parquet"))) == 1 for d in days)


def test_due_retries_come_back_once(spark, tmp_path):
    incoming = tmp_path / "in"
    _put(incoming, "a", [_line(1, humidity_pct=101), _line(2)])
    _run(spark, tmp_path)
    later = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    root = str(tmp_path / "out")
    assert event_flow.replay_due(spark, root, str(incoming), F.current_timestamp() - F.expr("INTERVAL 1 HOUR")).count() == 0
    assert event_flow.replay_due(spark, root, str(incoming), later).count() == 1
    assert event_flow.replay_due(spark, root, str(incoming), later).count() == 0
    got = _run(spark, tmp_path)
    assert got["input"] == 3 and got["retry"] == 2
    counts = {r["retry_count"] for r in event_flow.table(spark, root, "retry").collect()}
    assert counts == {1, 2}


def test_tolerant_and_missing(spark, tmp_path):
    _put(tmp_path / "in", "a", [_line(1), "nonsense", "", "42"])
    lines = json_lines.read_lines(spark, str(tmp_path / "in"))
    assert json_lines.tolerant(lines).count() == 1
    assert json_lines.read_lines(spark, str(tmp_path / "nowhere")).count() == 0
