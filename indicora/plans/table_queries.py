"""Queries over stored tables and flows: versions, ledgers, state, uploads, ordered pages, retention, raw folders."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions import keys
from indicora.functions.numbers import rounded
from indicora.learning import features, forest, histogram_forest, isolation, registry
from indicora.operators import events, filters, ordered, risk, service
from indicora.plans import etl, retention, star, views
from indicora.plans.queries import _now, _routed, _rules, _shown, _stamp, query
from indicora.scaling import constant_table
from indicora.session import scratch_path
from indicora.sources import csv_folder, tables
from indicora.sources.commits import Commits, vacuum
from indicora.sources.key_index import KeyIndex

LATER = 4e9  # a time long after every file was written, so that no grace period holds


# --- versions, ledger, facts -----------------------------------------------------------------------
@query
def concurrent_versions(spark, folder):
    """Four writers publish at once; every version is there, whole, under its own number."""
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "concurrent")
    own = [orders.where(F.col("o_orderkey") % 4 == k) for k in range(4)]
    with ThreadPoolExecutor(4) as writers:
        list(writers.map(lambda rows: tables.replace_table(rows, path), own))
    numbers = Commits(spark, path).versions()
    parts = None
    for n in numbers:
        rows = spark.read.parquet(tables.current_version(spark, path, n))
        part = rows.agg((F.min("o_orderkey") % 4).alias("writer"), F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.withColumn("versions", F.lit(len(numbers)))


def _fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    day = events.event_day(F.col("timestamp")).alias("zone")
    return views.sensor_events(spark, folder).select("seq", day, keys.event_fingerprint().alias("key"))


@query
def ledger_known(spark, folder):
    """Fingerprints remembered in three batches, merged in between while one runs again; then all are asked for."""
    book = KeyIndex(spark, scratch_path(spark, "ledger"))
    prints = _fingerprints(spark, folder)
    for batch in (0, 1):
        book.add(prints.where(F.col("seq") % 5 == batch), batch)
    book.compact(1)
    for batch in (1, 2):
        book.add(prints.where(F.col("seq") % 5 == batch), batch)
    known = book.known(prints).withColumn("known", F.lit(True))
    return prints.join(known, ["zone", "key"], "left").groupBy(F.col("zone").alias("event_day")).agg(
        F.count(F.lit(1)).alias("asked"), F.count("known").alias("known")
    )


@query
def fact_load_incremental(spark, folder):
    """Overlapping loads of the weather fact, one of them twice under its number and once more under a new one."""
    incoming = events.routed(views.sensor_events(spark, folder), _rules(), ["seq"]).where("outcome = 'accepted'")
    root = scratch_path(spark, "weather-star")
    incoming.select("seq", *events.EVENT_COLUMNS).write.parquet(f"{root}/accepted")  # routed once for all loads
    incoming = spark.read.parquet(f"{root}/accepted")
    plan = [("first", "seq % 3 < 2", 0), ("second", "seq % 3 > 0", 1), ("second again", "seq % 3 > 0", 1), ("late copy", "seq % 3 > 0", 2)]
    told = None
    for label, rows, number in plan:
        counts = star.load_weather(spark, incoming.where(rows), root, ["seq"], number).withColumn("load", F.lit(label))
        told = counts if told is None else told.unionByName(counts)
    stored = star.facts(spark, root, "fact_weather").agg(
        F.count(F.lit(1)).alias("input"), F.countDistinct("event_id").alias("inserted"), F.lit(0).cast("long").alias("duplicates"),
    ).withColumn("load", F.lit("stored"))
    return told.unionByName(stored)


@query
def health_load_incremental(spark, folder):
    """The long table loaded by overlapping ranges of years: one fact per natural key."""
    rows = views.indicator_obs(spark, folder)
    root = scratch_path(spark, "health-star")
    metadata = spark.createDataFrame([], "indicator string, indicator_label string, description string, source_url string")
    for limit in ("year < 1996", "year >= 1994"):
        star.load_health(spark, rows.where(limit), metadata, root)
    return star.facts(spark, root, "fact_health").groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("total")
    )


# --- uploads and replays ---------------------------------------------------------------------------
@query
def outbox_sync(spark, folder):
    """Events kept in four chunks: one upload breaks off and is resumed, the last chunk is still waiting."""
    from indicora.streaming.outbox import Outbox

    root = scratch_path(spark, "outbox")
    line = F.to_json(F.struct(*events.EVENT_COLUMNS))
    lines = views.sensor_events(spark, folder).select("seq", line.alias("value"))
    box = Outbox(spark, f"{root}/box", f"{root}/incoming")
    for k in range(3):
        box.store(lines.where(F.col("seq") % 4 == k))
    box.upload(box.claim(most_chunks=1))  # breaks off before it is acknowledged
    box.claim(most_chunks=1)  # and the next one before anything is sent
    box.synchronise()
    box.store(lines.where("seq % 4 = 3"))
    arrived = spark.read.option("recursiveFileLookup", True).text(f"{root}/incoming")
    received = arrived.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("value").alias("chunks"))
    return box.status().unionByName(received.withColumn("status", F.lit("received, distinct")))


@query
def corrected_replay(spark, folder):
    """Dead letters of one kind are corrected and go through the flow again; letters stay, marked as resolved."""
    from indicora.streaming import event_flow
    from indicora.streaming.outbox import Outbox

    root = scratch_path(spark, "replay")
    names = [r[0] for r in views.table(spark, folder, "nation").select("n_name").collect()]
    line = F.to_json(F.struct(*events.EVENT_COLUMNS, "retry_count"))
    box = Outbox(spark, f"{root}/box", f"{root}/incoming")
    box.store(views.sensor_events(spark, folder).select(line.alias("value")))
    box.synchronise()

    def take_in() -> None:
        event_flow.start(spark, f"{root}/incoming", f"{root}/out", f"{root}/progress", countries=names).awaitTermination()

    take_in()
    payload = F.col("original_payload")
    mended = F.regexp_replace(F.regexp_replace(payload, '"temperature_c":[0-9.E-]+', '"temperature_c":30.0'), '"humidity_pct":[0-9.E-]+', '"humidity_pct":50.0')
    fixes = event_flow.table(spark, f"{root}/out", "dlq").where("retry_count = 6").select("original_payload", mended.alias("new_payload"))
    event_flow.replay_corrected(spark, f"{root}/out", box, fixes, _now(), "corrected")
    event_flow.replay_corrected(spark, f"{root}/out", box, fixes, _now(), "again")  # nothing is left to do
    take_in()
    letters = event_flow.dead_letters(spark, f"{root}/out").agg(
        F.count(F.lit(1)).alias("letters"), F.count("resolved_at").alias("resolved"), F.max("resolution_notes").alias("note")
    ).first()
    outcomes = event_flow.counts(spark, f"{root}/out").select("accepted", "duplicate", "retry", "dlq")
    return outcomes.withColumns({
        "letters": F.lit(letters["letters"]).cast("long"), "resolved": F.lit(letters["resolved"]).cast("long"), "note": F.lit(letters["note"]).cast("string"),
    })


# --- service windows ----------------------------------------------------------------------------------
@query
def latency_stream(spark, folder):
    """Exact 95th percentiles of a stream's windows, in four runs; the last windows are still open."""
    from indicora.streaming import alert_flow

    root = scratch_path(spark, "latency-stream")
    signals = views.table(spark, folder, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = signals.agg(F.min(at), F.max(at)).first()
    quarter = F.floor((at - F.lit(first)) * 4 / (F.lit(last) - F.lit(first) + 1))
    for part in range(4):
        signals.where(quarter == part).write.mode("append").parquet(f"{root}/incoming")
        incoming = spark.readStream.schema(signals.schema).parquet(f"{root}/incoming")
        rows = views.as_ops_events(incoming).withColumn("latency", F.col("value") / 100)
        alert_flow.start_latency(rows, "latency", f"{root}/windows", f"{root}/progress", "10 minutes", "1 hour", 2.0).awaitTermination()
    found = alert_flow.latency_table(spark, f"{root}/windows")
    return found.select(_shown(F.col("window_start")).alias("window_start"), "events", rounded("p95", 6).alias("p95"), "alerting")


@query
def late_data(spark, folder):
    """Error rates of a stream whose last run brings signals a day late: they change no window."""
    from indicora.streaming import alert_flow

    root = scratch_path(spark, "late-stream")
    signals = views.table(spark, folder, "events")
    newest = signals.agg(F.max("ts")).first()[0]
    old = F.col("ts") < F.lit(newest) - F.expr("INTERVAL 1 DAY")
    for rows in (signals, signals.where(old)):
        rows.write.mode("append").parquet(f"{root}/incoming")
        incoming = views.as_ops_events(spark.readStream.schema(signals.schema).parquet(f"{root}/incoming"))
        rates = alert_flow.windowed_errors(incoming, F.col("status") == "failed", "10 minutes", "1 hour")
        flow = rates.writeStream.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True)
        flow.format("parquet").start(f"{root}/windows").awaitTermination()
    return spark.read.parquet(f"{root}/windows").agg(
        F.count(F.lit(1)).alias("windows"), F.countDistinct("window_start").alias("starts"), F.sum("events").alias("events"), F.sum("errors").alias("errors")
    )


@query
def dlq_growth(spark, folder):
    """Hours in which dead letters jumped against the three hours before."""
    letters = events.dead_letters(_routed(spark, folder), _rules(), _stamp())
    found = service.window_growth(letters, "failed_at", 60, 3, 1.5, 2)
    return found.withColumn("window_start", _shown(F.col("window_start")))


# --- order, pages, retention ------------------------------------------------------------------------------
PAGE = 200


@query
def deep_page(spark, folder):
    """The page in the middle of all line items, in an order in which most rows tie."""
    lines = views.table(spark, folder, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber")
    path = scratch_path(spark, "ordered")
    n = lines.count()
    ordered.write_ordered(lines, ["l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber"], path, max(1, n // 16))
    page = ordered.read_page(spark, path, n // 2, PAGE)
    return page.select("row_number", "l_returnflag", "l_orderkey", "l_linenumber")


@query
def output_order(spark, folder):
    """The long table in its output order: neighbours over the whole table, across files."""
    path = scratch_path(spark, "long-ordered")
    rows = views.indicator_obs(spark, folder)
    ordered.write_ordered(rows, etl.OUTPUT_ORDER, path, max(1, rows.count() // 8))
    page = ordered.read_page(spark, path, 0, 1 << 40)
    return page.select("row_number", "indicator", "country", "year", "sub_indicator", rounded("value", 2).alias("value"))


@query
def retention_job(spark, folder):
    """What the job leaves on disk of two tables by month, after the vacuum."""
    now = F.lit("2001-06-15").cast("timestamp")
    lines = views.table(spark, folder, "lineitem").select("l_orderkey", "l_linestatus", F.col("l_shipdate").cast("timestamp").alias("at"))
    stamped = lines.withColumns({
        "month": F.date_format("at", "yyyy-MM"), "accepted_at": F.col("at"), "failed_at": F.col("at"),
        "resolved_at": F.when(F.col("l_linestatus") == "F", F.col("at")),
    })
    out = None
    for kind in ("accepted", "dlq"):
        path = scratch_path(spark, f"kept-{kind}")
        for half in (0, 1):
            retention.append(stamped.where(F.col("l_orderkey") % 2 == half), path, "month")
        retention.apply(spark, path, filters.retained(kind, now))
        vacuum(spark, path, now=LATER)
        left = spark.read.schema(stamped.schema).option("recursiveFileLookup", True).parquet(path)
        own = left.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("order_keys")).withColumn("kind", F.lit(kind))
        out = own if out is None else out.unionByName(own)
    return out


# --- raw folders ----------------------------------------------------------------------------------------
PLACES = ["Viet Nam", " lao pdr", "Thailand ", "Brunei  Darussalam", "MYANMAR", "Atlantis"]


def _put(spark: SparkSession, rows: DataFrame, folder: str, name: str, **options) -> None:
    """One CSV file of this name, as a raw folder holds it."""
    made = scratch_path(spark, "one-file")
    rows.coalesce(1).write.options(**({"header": True} | options)).csv(made)
    store = Commits(spark, folder)
    part = next(n for n, _ in store.names(made) if n.startswith("part-"))
    store.place(f"{made}/{part}", f"{folder}/{name}")


def _raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    places = F.array(*[F.lit(p) for p in PLACES])
    named = views.table(spark, folder, "customer").select("c_custkey", F.element_at(places, (F.col("c_nationkey") % 6 + 1).cast("int")).alias("place"))
    orders = views.table(spark, folder, "orders").join(named, F.col("o_custkey") == F.col("c_custkey"))
    return orders.groupBy("place", F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _raw_folder(spark: SparkSession, folder: str) -> str:
    """Wide, long, unreadable and empty files, in three charsets."""
    raw = scratch_path(spark, "raw")
    rows = _raw_rows(spark, folder)
    years = sorted(r[0] for r in rows.select("year").distinct().collect())
    wide = rows.where("o_orderstatus = 'O'").groupBy("place").pivot("year", years).agg(F.first("n"))
    _put(spark, wide.withColumnRenamed("place", "Countries and areas").withColumn("note", F.lit("é")), raw, "Open  Orders (Total).csv", encoding="ISO-8859-1")
    shown = F.concat(F.lit("< "), F.format_number("n", 0))
    longer = rows.where("o_orderstatus = 'F'").select(F.col("place").alias("Country"), F.col("year").alias("Year"), shown.alias("Value"), F.lit("orders").alias("Unit"))
    _put(spark, longer, raw, "filled_orders.csv")
    bad = rows.where("o_orderstatus = 'F'").select(F.col("place").alias("who"), F.col("n").alias("Value"))
    _put(spark, bad, raw, "no_place.csv")
    _put(spark, rows.limit(0), raw, "no_rows.csv")
    return raw


@query
def raw_folder_etl(spark, folder):
    """A raw folder of wide and long files to the long table: names, numbers, domain filters, indicators from file names."""
    loaded = etl.load_folder(spark, _raw_folder(spark, folder))
    return loaded.table.select("indicator", "country", "year", "unit", "value")


@query
def raw_folder_report(spark, folder):
    """What became of every file of the same folder."""
    report = etl.load_report(spark, etl.load_folder(spark, _raw_folder(spark, folder)))
    return report.select("file_name", "status", "rows", F.col("reason").isNotNull().alias("has_reason"))


@query
def raw_folder_charsets(spark, folder):
    """Layouts that a scan finds: header, charset, excluded files."""
    raw = _raw_folder(spark, folder)
    found = csv_folder.manifest(spark, raw, frozenset({"no_place.csv"}))
    rows = sorted((csv_folder.file_name_of(p).replace("%20", " "), lay.charset, len(lay.header)) for lay, paths in found.layouts.items() for p in paths)
    return constant_table(spark, {"file_name": [r[0] for r in rows], "charset": [r[1] for r in rows]})


@query
def typed_scan(spark, folder):
    """A long CSV with blanks, unreadable years and missing keys, read with enforced types."""
    path = scratch_path(spark, "typed")
    k = F.col("o_orderkey")
    orders = views.table(spark, folder, "orders")
    messy = orders.select(
        F.when(k % 11 == 0, None).otherwise(F.concat(F.lit("  "), "o_orderstatus", F.lit(" "))).alias("country"),
        F.when(k % 7 == 0, "n/a").otherwise(F.concat(F.year("o_orderdate").cast("string"), F.lit(".0"))).alias("year"),
        F.concat(F.lit(" "), "o_orderpriority").alias("indicator"), F.lit(None).cast("string").alias("sub_indicator"),
        F.lit(None).cast("string").alias("sex"), F.concat(F.lit('u "'), k.cast("string"), F.lit('",\n')).alias("unit"),
        F.when(k % 5 == 0, "?").otherwise(F.col("o_totalprice").cast("string")).alias("value"),
    )
    messy.write.csv(path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    kept = tables.read_long_csv(spark, path)
    return kept.groupBy("country", "indicator", "year").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("total"))


@query
def metadata_scan(spark, folder):
    """Indicator documentation from a CSV with quoted line breaks, and from a file that is not there."""
    path = f"{scratch_path(spark, 'metadata')}.csv"
    parts = views.table(spark, folder, "part").select(
        F.concat(F.lit("ind_"), "p_partkey").alias("indicator"), F.col("p_name").alias("indicator_label"),
        F.concat("p_type", F.lit(', "quoted"\nsecond line')).alias("description"), F.lit("src").alias("source_url"),
        *[F.lit(None).cast("string").alias(c) for c in ("raw_data", "issue_url", "is_cleansed", "should_combine", "remarks")],
    )
    parts.write.csv(path, header=True, escape='"')
    read = tables.read_metadata(spark, path).withColumn("present", F.lit(True))
    absent = tables.read_metadata(spark, f"{path}-absent.csv").withColumn("present", F.lit(False))
    both = read.unionByName(absent)
    return both.groupBy("present", F.split("description", ",")[0].alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("description").contains("\nsecond line")).alias("whole")
    )


# --- models -------------------------------------------------------------------------------------------
@query
def tree_samples(spark, folder):
    """Rows that two trees of an isolation forest learn from: merged from forty partitions, and from one."""
    rows = views.customer_series(spark, folder).select("o_custkey", "year", "value", F.col("year").cast("double").alias("at"))
    out = None
    for label, parts in (("one", 1), ("forty", 40)):
        drawn = isolation._samples(rows.repartition(parts), ["o_custkey", "year"], ["value", "at"], 2)
        own = drawn.groupBy("tree").agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("value", "at").alias("distinct_rows"), rounded(F.sum("value"), 2).alias("total")
        ).withColumn("from", F.lit(label))
        out = own if out is None else out.unionByName(own)
    same = out.groupBy("tree").agg(F.min("n").alias("n"), F.max("n").alias("most"), F.countDistinct("total").alias("samples"))
    return same.select("tree", "n", "most", "samples")


@query
def regression_stump(spark, folder):
    """A tree of one split over all line items, from histograms that tasks add up."""
    lines = views.table(spark, folder, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber").alias("key"), F.col("l_extendedprice").alias("value"), "l_tax", "l_quantity", "l_discount"
    )
    ready = VectorAssembler(inputCols=["l_tax", "l_quantity", "l_discount"], outputCol="features").transform(lines)
    tree = histogram_forest.fit(ready, 1, 1, 2, None, local=500).trees[0]
    low, high = tree["low"][0], tree["high"][0]
    return constant_table(spark, {
        "feature": [["l_tax", "l_quantity", "l_discount"][tree["split"][0]]], "cut": [float(tree["cut"][0])],
        "value_low": [round(float(tree["value"][low]), 2)], "value_high": [round(float(tree["value"][high]), 2)], "leaves": [int((tree["low"] < 0).sum())],
    })


@query
def importance_facts(spark, folder):
    """What importances must hold: one per name and number, none negative, one in sum, the top ones in order."""
    annual = views.indicator_series(spark, folder)
    model = forest.train(features.holdout(features.forecast_frame(annual))[0], trees=8)
    every = model.importances(spark, top=10_000)
    top = [r["importance"] for r in model.importances(spark).collect()]
    return every.agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("importance") < 0).alias("negative"), F.round(F.sum("importance"), 3).alias("total")
    ).withColumns({"top": F.lit(len(top)), "in_order": F.lit(top == sorted(top, reverse=True))})


@query
def direction_union(spark, folder):
    """Orders dealt to indicators, counted where either risk profile gives the indicator a direction."""
    profiles = [risk.direction_table(spark, p).select("indicator") for p in vocab.DIRECTIONS]
    directed = reduce(DataFrame.unionByName, profiles).distinct()
    names = F.array(*[F.lit(n) for n in [*sorted(set().union(*vocab.DIRECTIONS.values())), "rainfall", "population"]])
    dealt = views.table(spark, folder, "orders").select((F.col("o_orderkey") % F.size(names)).alias("slot"), "o_totalprice")
    named = dealt.withColumn("indicator", F.element_at(names, (F.col("slot") + 1).cast("int")))
    return named.join(directed, "indicator").groupBy("slot").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("o_totalprice"), 2).alias("total"))


@query
def registry_entries(spark, folder):
    """Three runs in a registry of models; the newest entry of a kind stands."""
    root = scratch_path(spark, "registry")
    series = views.indicator_series(spark, folder)
    for run in range(3):
        learned = registry.lineage(series.where(F.col("year") <= 1994 + run))
        registry.append(spark, root, [("forecast", f"forecast-{run}", "nowhere", *learned, {"run": float(run)}, {"kept": True})])
    entries = registry.read(spark, root)
    return registry.newest(entries).select(
        "kind", "version", "rows", "countries", "indicators", "year_min", "year_max", F.lit(entries.count()).cast("long").alias("entries")
    )
