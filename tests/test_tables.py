"""Versions, key index, keyed state, outbox, ordered tables, retention."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from indicora.operators import filters, ordered, service
from indicora.plans import retention, star
from indicora.sources import key_index, tables
from indicora.sources.commits import Commits, vacuum
from indicora.sources.key_index import KeyIndex
from indicora.streaming.keyed_state import KeyedState
from indicora.streaming.outbox import Outbox

LATER = 4e9


# --- versions
def test_writers_at_once_all_publish(spark, tmp_path):
    log = Commits(spark, str(tmp_path / "t"))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: log.commit(lambda held: [*held, {"folder": f"f{k}"}]), range(24)))
    assert log.versions() == list(range(24))
    assert {e["folder"] for e in log.entries()} == {f"f{k}" for k in range(24)}
    for n in range(24):  # every version adds one entry to the one before
        assert len(log.entries(n)) == n + 1 and log.entries(n)[:n] == (log.entries(n - 1) if n else [])
    assert not [name for name, _ in log.names(log.log) if name.startswith("claim-")]


def test_a_number_is_claimed_once(spark, tmp_path):
    log = Commits(spark, str(tmp_path / "t"))
    assert log.claim(0, [{"folder": "a"}]) and not log.claim(0, [{"folder": "b"}])
    assert log.entries() == [{"folder": "a"}]


def test_published_tables_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.current_version(spark, path) is None
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: tables.replace_table(spark.range(n), path), (3, 5)))
    assert sorted(spark.read.parquet(tables.current_version(spark, path, v)).count() for v in (0, 1)) == [3, 5]
    old, new = tables.current_version(spark, path, 0), tables.current_version(spark, path)
    assert vacuum(spark, path, keep_versions=2, now=LATER) == []
    assert vacuum(spark, path) == [f"{path}/_versions/v-0000000000"]  # files are too young
    assert vacuum(spark, path, now=LATER) == [old]
    assert spark.read.parquet(new).count() in (3, 5) and Commits(spark, path).versions() == [1]


# --- key index
def _keys(spark, pairs):
    return spark.createDataFrame([(z, k) for z, k in pairs], "zone string, key string")


def _known(book, asked, batch=None):
    return {tuple(r) for r in book.known(asked, batch).collect()}


@pytest.mark.parametrize("small", [0, 1 << 17])
def test_known_keys(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(key_index, "SMALL_KEYS", small)
    monkeypatch.setattr(key_index, "PART_KEYS", 4)
    pick = random.Random(small)
    book = KeyIndex(spark, str(tmp_path / "i"))
    every = [(f"2024-01-0{d}", f"k{n}") for d in range(1, 6) for n in range(60)]
    assert _known(book, _keys(spark, every)) == set()
    held: dict[int, set] = {}
    for batch in range(5):
        chosen = set(pick.sample(every, 40)) - set().union(*held.values())
        held[batch] = chosen
        book.add(_keys(spark, sorted(chosen) * 2), batch)
        if batch in (2, 4):
            assert book.compact(2 if batch == 2 else 1) and len(book.log.entries()) == 1
            book.add(_keys(spark, sorted(chosen)), batch)  # runs again after it was merged
            assert len(book.log.entries()) == 1
    asked = _keys(spark, [*every, ("2024-02-01", "k1")])
    assert _known(book, asked) == set().union(*held.values())
    assert _known(book, asked, 3) == set().union(*(held[b] for b in held if b != 3))
    assert book.log.entries()[0]["batches"] == [[0, 4]]


def test_adding_a_batch_again_replaces_it(spark, tmp_path):
    book = KeyIndex(spark, str(tmp_path / "i"))
    book.add(_keys(spark, [("a", "1"), ("a", "2")]), 0)
    book.add(_keys(spark, [("a", "2"), ("b", "3")]), 0)
    assert _known(book, _keys(spark, [("a", "1"), ("a", "2"), ("b", "3"), ("b", "1")])) == {("a", "2"), ("b", "3")}
    assert _known(book, _keys(spark, [("a", "2")]), 0) == set()
    with pytest.raises(ValueError):
        book.add(_keys(spark, [("a/b", "1")]), 1)


def test_only_touched_places_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "SMALL_KEYS", 0)
    monkeypatch.setattr(key_index, "PART_KEYS", 16)
    book = KeyIndex(spark, str(tmp_path / "i"))
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    book.add(_keys(spark, [(d, f"k{n}") for d in days for n in range(200)]), 0)
    book.add(_keys(spark, [(days[0], f"m{n}") for n in range(30)]), 1)
    entries = book.touched([days[3]])
    assert [e["batches"] for e in entries] == [[[0, 0]]]
    assert len(book.mark_paths(entries, [days[3]])) == 1
    opened = []
    monkeypatch.setattr(book, "key_paths", lambda e, w, f=book.key_paths: opened.append(f(e, w)) or f(e, w))
    # new keys: their bits are not all set, so hardly any key file is opened
    assert _known(book, _keys(spark, [(days[3], f"new{n}") for n in range(20)])) == set()
    assert len(opened[-1]) <= 8
    plan = book.known(_keys(spark, [(days[3], "k7")]))._jdf.queryExecution().executedPlan().toString()
    assert len(opened[-1]) == 1 and f"_zone={days[3]}" in opened[-1][0]
    assert "_zone=2024-01-05" not in plan


def test_many_zones_are_asked_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_ZONES", 3)
    book = KeyIndex(spark, str(tmp_path / "i"))
    pairs = [(f"z{n}", "k") for n in range(10)]
    book.add(_keys(spark, pairs[:6]), 0)
    assert _known(book, _keys(spark, pairs)) == set(pairs[:6])


# --- facts
def test_a_load_reads_no_facts_and_can_break_off(spark, tmp_path, monkeypatch):
    shape = "event_id string, station_id string, country string, timestamp string, temperature_c double, humidity_pct double, rainfall_mm double, seq long"
    rows = lambda *ids: spark.createDataFrame([(i, "TH-BKK-01", "Laos", "2026-07-12T09:15:30Z", 1.0, 2.0, 3.0, n) for n, i in enumerate(ids)], shape)
    root = str(tmp_path)
    assert tuple(star.load_weather(spark, rows("a", "b", "a"), root, ["seq"], 0).first()) == (3, 2, 1)
    monkeypatch.setattr(KeyIndex, "add", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        star.load_weather(spark, rows("b", "c"), root, ["seq"], 1)
    monkeypatch.undo()
    assert star.facts(spark, root, "fact_weather").count() == 2  # what was written is not published
    assert tuple(star.load_weather(spark, rows("b", "c"), root, ["seq"], 1).first()) == (2, 1, 1)
    assert tuple(star.load_weather(spark, rows("b", "c"), root, ["seq"], 1).first()) == (2, 1, 1)  # again, under its number
    assert tuple(star.load_weather(spark, rows("b", "c"), root, ["seq"]).first()) == (2, 0, 2)
    assert sorted(r[0] for r in star.facts(spark, root, "fact_weather").select("event_id").collect()) == ["a", "b", "c"]
    assert star.facts(spark, root, "fact_health") is None


def test_a_load_computes_its_rows_once(spark, tmp_path):
    """Dimensions, keys and facts come from one pass over rows that may be costly to make."""
    shape = "event_id string, station_id string, country string, timestamp string, temperature_c double, humidity_pct double, rainfall_mm double, seq long"
    for load in range(2):
        made = spark.sparkContext.accumulator(0)

        def counted(batches, made=made):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        ids = range(load * 50, load * 50 + 100)
        rows = spark.createDataFrame([(f"e{i}", "TH-BKK-01", "Laos", f"2026-07-{i % 28 + 1:02}T09:15:30Z", 1.0, 2.0, 3.0, i) for i in ids], shape)
        told = star.load_weather(spark, rows.mapInArrow(counted, shape), str(tmp_path), ["seq"], load).first()
        assert tuple(told) == ((100, 100, 0), (100, 50, 50))[load] and made.value == 100
    assert star.facts(spark, str(tmp_path), "fact_weather").select("event_id").distinct().count() == 150
    # a day's rows are not dealt over many small files
    assert max(len(list(p.glob("*.parquet"))) for p in tmp_path.glob("fact_weather/*/date_key=*")) == 1


# --- keyed state
def test_state_writes_what_changed(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long").schema
    state = KeyedState(spark, str(tmp_path / "s"), "k", schema)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    gone = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    held: dict = {}
    for batch in range(7):
        new = {f"k{n}": batch for n in range(batch, batch + 5)}
        dropped = {f"k{batch - 1}"} if batch else set()
        seen = {r["k"]: r["v"] for r in state.get(gone(*new, *dropped), batch).collect()}
        assert seen == {k: v for k, v in held.items() if k in set(new) | dropped}
        for _ in range(2 if batch % 4 == 3 else 1):  # some batches run twice
            state.put(frame(list(new.items())), gone(*dropped), batch)
        last = max(state.log.entries(), key=lambda e: e["batches"][1])
        assert spark.read.parquet(last["folder"]).count() == len(new) + len(dropped)
        held = {k: v for k, v in (held | new).items() if k not in dropped}
        state.compact(batch, most_entries=3)
        assert {r["k"]: r["v"] for r in state.all().collect()} == held
    assert len(state.log.entries()) <= 5 and state.batches()[-1] == 6
    assert len(state.paths(None, {0})) <= len(state.log.entries())


# --- outbox
def test_broken_off_uploads_lose_and_repeat_nothing(spark, tmp_path):
    incoming = str(tmp_path / "in")
    box = Outbox(spark, str(tmp_path / "box"), incoming)
    assert box.synchronise() == [] and {r["status"]: r["records"] for r in box.status().collect()} == {"unsynchronised": 0, "pending": 0, "acknowledged": 0}
    lines = lambda *n: spark.createDataFrame([(f"line {k}",) for k in n], "value string")
    for k in range(4):
        box.store(lines(3 * k, 3 * k + 1, 3 * k + 2))
    first = box.claim(2)
    with pytest.raises(ValueError):
        box.acknowledge(first)
    box.upload(first)
    box.upload(first)  # has arrived: nothing happens
    second = box.claim(1)
    other = Outbox(spark, str(tmp_path / "box"), incoming)  # after a restart
    assert other.pending() == [first, second]
    assert other.synchronise(1) == [first, second, 2]
    got = sorted(r["value"] for r in spark.read.option("recursiveFileLookup", True).text(incoming).collect())
    assert got == sorted(f"line {k}" for k in range(12))
    assert {r["status"]: r["chunks"] for r in other.status().collect()} == {"unsynchronised": 0, "pending": 0, "acknowledged": 4}
    other.forget()
    assert len(other.log.entries()) == 1 and len(vacuum(spark, str(tmp_path / "box"), now=LATER)) >= 3
    box.store(lines(100))
    assert box.synchronise() == [3]  # numbers go on


def test_uploads_at_once_claim_apart(spark, tmp_path):
    box = Outbox(spark, str(tmp_path / "box"), str(tmp_path / "in"))
    for k in range(4):
        box.store(spark.createDataFrame([(f"{k}",)], "value string"))
    with ThreadPoolExecutor(4) as pool:
        epochs = list(pool.map(lambda _: box.claim(1), range(4)))
    assert sorted(epochs) == [0, 1, 2, 3]


# --- order and pages
def test_pages_of_an_ordered_table(spark, tmp_path):
    pick = random.Random(2)
    data = [(pick.choice([None, "a", "a", "a", "b"]), pick.choice([None, 1, 2]), n % 50) for n in range(400)]
    df = spark.createDataFrame(data, "a string, b int, c int").repartition(5)
    path = str(tmp_path / "o")
    ordered.write_ordered(df, ["a", "b"], path, 30)
    last = lambda v: (v is None, v)
    want = sorted(((a, b) for a, b, _ in data), key=lambda r: (last(r[0]), last(r[1])))
    pages = [r for at in range(0, 400, 37) for r in ordered.read_page(spark, path, at, 37).collect()]
    assert [r["row_number"] for r in pages] == list(range(1, 401))
    assert [(r["a"], r["b"]) for r in pages] == want
    assert sorted((str(r["a"]), str(r["b"]), r["c"]) for r in pages) == sorted((str(a), str(b), c) for a, b, c in data)
    sizes = [r["n"] for r in Commits(spark, path).entries()[0]["ranges"]]
    assert max(sizes) < 120  # a value that most rows share is split
    assert len(ordered.page_ranges(spark, path, 200, 10)) <= 2
    assert ordered.read_page(spark, path, 400, 10).count() == 0 and ordered.read_page(spark, path, 395, 10).count() == 5
    ordered.write_ordered(df.limit(0), ["a"], path)
    assert ordered.read_page(spark, path).columns == ["a", "b", "c", "row_number"] and ordered.read_page(spark, path).count() == 0


# --- retention
def test_retention_keeps_what_the_rule_says(spark, tmp_path):
    path = str(tmp_path / "t")
    now = F.lit("2024-03-15").cast("timestamp")
    rows = spark.range(900).select(
        "id", (F.lit("2022-10-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("accepted_at")
    ).withColumn("month", F.date_format("accepted_at", "yyyy-MM"))
    keep = filters.retained("accepted", now)
    retention.append(rows.where("id % 2 = 0"), path, "month")
    retention.append(rows.where("id % 2 = 1"), path, "month")
    before = {e["folder"] for e in Commits(spark, path).entries()}
    told = retention.apply(spark, path, keep)
    assert told["rewritten"] == 2 and told["dropped"] == 10 and told["kept"] == len(before) - 12
    want = {r["id"] for r in rows.where(keep).collect()}
    assert {r["id"] for r in retention.read(spark, path).collect()} == want
    assert retention.read(spark, path, 1).count() == 900  # readers of the version before see it whole
    vacuum(spark, path, now=LATER)
    left = spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(path)
    assert {r["id"] for r in left.collect()} == want
    assert retention.apply(spark, path, keep) == {"kept": told["kept"] + 1, "dropped": 0, "rewritten": 0}
    assert retention.apply(spark, str(tmp_path / "none"), keep) == {"kept": 0, "dropped": 0, "rewritten": 0}


# --- service windows
def test_sketched_percentiles_are_within_their_error(spark):
    rows = spark.range(60_000).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 20).cast("int"))).alias("observed_at"),
        (F.xxhash64("id") % 100_000 / 1000.0).alias("v"),
    )
    values: dict = {}
    for r in rows.select(F.window("observed_at", "5 minutes").start.alias("w"), "v").collect():
        values.setdefault(r["w"], []).append(r["v"])
    for r in service.window_latency_sketch(rows, "v", accuracy=200).collect():
        own = sorted(values[r["window_start"]])
        rank = sum(x <= r["p95"] for x in own)
        assert len(own) == r["events"] and abs(rank - 0.95 * len(own)) <= len(own) / 200 + 1


def test_percentiles_of_a_stream_are_exact_in_large_windows(spark, tmp_path):
    """Windows of more events than a sketch keeps; nulls, infinities, and windows without a latency."""
    from indicora.streaming import alert_flow

    at = F.timestamp_seconds(F.lit(1_700_000_400) + F.col("id") % 3 * 3600 + F.col("id") % 3000)
    value = F.when(F.col("id") % 3 == 2, None).when(F.col("id") % 50 == 7, None).when(F.col("id") % 1000 == 1, float("inf")).otherwise(F.xxhash64("id") % 40_000 / 7.0)
    rows = spark.range(90_000).select(at.alias("observed_at"), value.alias("v"))
    newer = spark.range(1).select(F.timestamp_seconds(F.lit(1_700_100_000)).alias("observed_at"), F.lit(1.0).alias("v"))
    for part in (rows.where("v < 100"), rows.where("v IS NULL OR v >= 100"), newer):
        part.write.mode("append").parquet(str(tmp_path / "in"))
    incoming = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    root = str(tmp_path / "windows")
    assert alert_flow.latency_table(spark, root).count() == 0
    alert_flow.start_latency(incoming, "v", root, str(tmp_path / "progress"), width="1 hour").awaitTermination()
    got = {r["window_start"]: (r["events"], r["p95"], r["alerting"]) for r in alert_flow.latency_table(spark, root).collect()}
    held: dict = {}
    for r in rows.select(F.window("observed_at", "1 hour").start.alias("w"), "v").collect():
        held.setdefault(r["w"], []).append(r["v"])
    want = {}
    for w, values in held.items():
        known = sorted(v for v in values if v is not None)
        p95 = known[-(-95 * len(known) // 100) - 1] if known else None
        want[w] = (len(values), p95, None if p95 is None else p95 > 2.0)
    assert got == want and len(want) >= 3 and None in {p for _, p, _ in want.values()}


def test_open_windows_of_a_latency_stream_take_no_memory(spark, tmp_path):
    """A state store would hold a row per latency of the open windows in the executors' heap."""
    from indicora.streaming import alert_flow

    at = F.timestamp_seconds(F.lit(1_700_006_400) + F.col("id") % 7200)
    spark.range(40_000).select(at.alias("observed_at"), (F.col("id") / 8.0).alias("v")).write.parquet(str(tmp_path / "in"))
    incoming = spark.readStream.schema("observed_at timestamp, v double").parquet(str(tmp_path / "in"))
    flow = alert_flow.start_latency(incoming, "v", str(tmp_path / "windows"), str(tmp_path / "progress"), width="1 day")
    flow.awaitTermination()
    assert sum(p["numInputRows"] for p in flow.recentProgress) == 40_000
    held = [o["numRowsTotal"] for p in flow.recentProgress for o in p["stateOperators"]]
    assert max(held, default=0) < 1_000
    assert alert_flow.latency_table(spark, str(tmp_path / "windows")).count() == 0  # the only window is open


@pytest.mark.parametrize("most", [16, 2])
def test_windows_of_a_latency_stream_close_over_batches(spark, tmp_path, monkeypatch, most):
    """Late events, batches without events, a batch that runs again, times before 1970, counts merged or not."""
    from indicora.streaming import alert_flow

    monkeypatch.setattr(alert_flow, "MOST_FOLDERS", most)
    root, hour, delay = str(tmp_path / "windows"), 3600, 600
    batches = [
        [(-9000, 7.0), (-9000, 8.0), (100, 1.0), (3500, None), (3599, 3.0)],
        [],
        [(3000, 2.5), (200, 9.0), (4100, 0.5)],  # the first hour is still open
        [(7199, 4.0), (-8000, 1.0), (3599, 50.0)],  # the last two are open, the one before is late
        [(3700, 4.5), (10, 99.0), (7300, 1.0), (7800, float("nan"))],  # the second is late
        [(3700, 1e6), (7400, 6.0), (11_000, 1.0)],  # the first is late
        [(90_000, 1.0)],
    ]
    held, want, watermark, read = {}, {}, None, []
    for k, rows in enumerate(batches):
        frame = spark.createDataFrame([(float(t), v) for t, v in rows], "t double, v double")
        frame = frame.select(F.timestamp_seconds("t").alias("observed_at"), "v")
        for _ in range(2 if k in (3, 5) else 1):  # the second run replaces the first
            alert_flow.close_windows(frame, k, "v", root, delay * 1_000_000, "1 hour", 2.0)
        for t, v in rows:
            if watermark is None or t // hour * hour + hour > watermark:
                held.setdefault(t // hour * hour, []).append(v)
        watermark = max([t - delay for t, _ in rows] + ([] if watermark is None else [watermark]))
        for w in [w for w in held if w + hour <= watermark]:
            values = held.pop(w)
            known = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
            want[w] = (len(values), repr(known[-(-95 * len(known) // 100) - 1]))
        read.append(Commits(spark, f"{root}/_open").entries())
    got = alert_flow.latency_table(spark, root).select(F.unix_seconds("window_start").alias("w"), "events", "p95").collect()
    assert {r["w"]: (r["events"], repr(r["p95"])) for r in got} == want and len(got) == len(want) == 5
    assert max(map(len, read)) <= most + 2 and any(e["merged"] for r in read for e in r) == (most == 2)
    left = {e["folder"] for e in Commits(spark, f"{root}/_open").entries()}
    assert {f"{root}/_open/{p.name}" for p in (tmp_path / "windows" / "_open").glob("counts-*")} == left
    with pytest.raises(FileNotFoundError):
        alert_flow.close_windows(frame, len(batches) + 1, "v", root, delay * 1_000_000, "1 hour", 2.0)


def test_growth_of_dead_letters(spark):
    per_window = {0: 4, 1: 4, 2: 4, 3: 12, 4: 12, 5: 12, 6: 12, 20: 3, 30: 50}
    rows = [(60 * 5 * w + k % 300,) for w, n in per_window.items() for k in range(n)]
    letters = spark.createDataFrame(rows, "s long").select(F.timestamp_seconds("s").alias("failed_at"))
    got = {r["w"]: (r["letters"], r["before"], r["alerting"]) for r in service.window_growth(letters, "failed_at").withColumn("w", (F.unix_seconds("window_start") / 300).cast("int")).collect()}
    before = lambda w: sum(per_window.get(w - k, 0) for k in (1, 2, 3))
    assert got == {w: (n, before(w), n >= 10 and 3 * n > 2 * before(w)) for w, n in per_window.items()}
    assert {w for w in got if got[w][2]} == {3, 30}
