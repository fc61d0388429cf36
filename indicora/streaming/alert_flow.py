"""Continuous alert lifecycle.

Every micro-batch is folded into alert segments by the batch operators, which spread a noisy key
over time slices; a state function per key would gather all its signals in one task. The open
segments of the keys it touches are looked up in a keyed state, and only changed keys are written
back. Folders below ``root``: closed/batch_id=<n> and open (the state); a batch that runs again
reads the state before it and replaces its own output.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from indicora.operators import alerts
from indicora.operators.service import latency_counts, window_growth, window_health, window_latency_of_counts, window_latency_sketch
from indicora.sources.commits import Commits
from indicora.sources.tables import exists
from indicora.streaming.keyed_state import KeyedState


def _merged(rows: DataFrame) -> DataFrame:
    """Join pieces of the same segment."""
    return rows.groupBy("dedup_key", "segment").agg(
        F.min("first").alias("first"),
        F.max_by("latest", "last").alias("latest"),
        F.max("last").alias("last"),
        F.sum("occurrences").alias("occurrences"),
        F.bool_or("resolved").alias("resolved"),
    )


def open_alerts(spark: SparkSession, root: str, schema: T.StructType) -> KeyedState:
    """Open segments by alert key."""
    return KeyedState(spark, f"{root}/open", "dedup_key", schema)


def fold_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    spark = batch.sparkSession
    fresh = alerts.segments(alerts.keyed(batch)).persist()
    state = open_alerts(spark, root, fresh.schema)
    try:
        if batch_id > 0 and batch_id - 1 not in state.batches():
            raise FileNotFoundError(f"open alerts of the batch before are missing: {root}/open, batch {batch_id - 1}")
        keys = fresh.select("dedup_key").distinct()
        # an open alert continues in the first segment of its key
        carried = state.get(keys, batch_id).withColumn("segment", F.lit(0).cast("long"))
        merged = _merged(fresh.unionByName(carried)).persist()
        try:
            closed, still = merged.where("resolved"), merged.where("NOT resolved")
            closed.write.mode("overwrite").parquet(f"{root}/closed/batch_id={batch_id}")
            ended = closed.select("dedup_key").distinct().join(still, "dedup_key", "left_anti")
            state.put(still, ended, batch_id)
        finally:
            merged.unpersist()
    finally:
        fresh.unpersist()
    state.compact(batch_id)  # this batch may run again from the state before it


def start(
    events: DataFrame, root: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """``events``: a streaming frame with the operational-event columns."""
    writer = events.writeStream.foreachBatch(
        lambda batch, batch_id: fold_batch(batch, batch_id, root)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def alert_table(
    spark: SparkSession, root: str, acknowledgements: DataFrame | None = None
) -> DataFrame:
    """All alerts: closed ones of every batch and those still open."""
    closed = spark.read.parquet(f"{root}/closed").drop("batch_id")
    still = open_alerts(spark, root, closed.schema).all()
    return alerts.alerts_of(closed.unionByName(still), acknowledgements)


def windowed_errors(
    events: DataFrame, failed: Column, lateness: str = "10 minutes", width: str = "5 minutes"
) -> DataFrame:
    """Error rate per event-time window of a stream; the watermark bounds the open windows."""
    return window_health(events.withWatermark("observed_at", lateness), failed, width)


def windowed_latency(
    events: DataFrame, latency: str, lateness: str = "10 minutes", width: str = "5 minutes", limit: float = 2.0, accuracy: int = 1000
) -> DataFrame:
    """95th percentile per event-time window of a stream, within a rank error of 1 / ``accuracy``."""
    return window_latency_sketch(events.withWatermark("observed_at", lateness), latency, width, limit, accuracy)


_LATENCY = "window_start timestamp, events long, p95 double, alerting boolean, batch_id long"
MOST_FOLDERS = 16  # of counts for the open windows, before a batch merges them


def close_windows(batch: DataFrame, batch_id: int, latency: str, root: str, lateness: int, width: str, limit: float) -> None:
    """Store a batch's counts and write the windows that its newest event closes.

    ``lateness`` in microseconds. A window is closed when it ends at or before the watermark, the
    newest time so far less the lateness; events of closed windows are late and dropped.
    """
    spark, state = batch.sparkSession, f"{root}/_open"
    log = Commits(spark, state)
    entries = log.entries()
    known = [e for e in entries if e["batch"] < batch_id]
    if batch_id > 0 and (not known or known[-1]["batch"] != batch_id - 1):
        raise FileNotFoundError(f"counts of the batch before are missing: {state}, batch {batch_id - 1}")
    closed = known[-1]["watermark"] if known else None
    is_open = F.lit(True) if closed is None else F.col("ends") > closed
    merged = max((k for k, e in enumerate(known) if e["merged"]), default=0)
    used = [e for e in known[merged:] if e["until"] is not None and (closed is None or e["until"] > closed)]

    counts = latency_counts(batch, latency, width).where(is_open)
    held = spark.read.schema(counts.schema).parquet(*[e["folder"] for e in used]).where(is_open) if used else None
    merge = len(used) >= MOST_FOLDERS
    if merge:
        both = counts.unionByName(held).groupBy("window_start", "ends", "latency")
        counts, held = both.agg(F.sum("n").alias("n"), F.max("latest").alias("latest")).select(*counts.columns), None
    folder = f"{state}/counts-{uuid.uuid4().hex}"
    counts.sortWithinPartitions("ends").write.parquet(folder)  # a reader of few windows skips the others' pages
    counts = spark.read.schema(counts.schema).parquet(folder)
    latest, until = counts.agg(F.max("latest"), F.max("ends")).first()
    reached = [t for t in (closed, None if latest is None else latest - lateness) if t is not None]
    watermark = max(reached, default=None)

    held = counts if held is None else held.unionByName(counts)
    closing = held.where(F.lit(False) if watermark == closed else F.col("ends") <= watermark)
    window_latency_of_counts(closing, limit).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
    # this batch may run again from the counts before it
    kept = [*(e for e in known[:-1] if e in used), *known[-1:]]
    entry = {"folder": folder, "batch": batch_id, "watermark": watermark, "until": until, "merged": merge}
    log.commit(lambda _: [*kept, entry])
    for e in entries:
        if e not in kept:
            log.delete(e["folder"])


def start_latency(
    events: DataFrame, latency: str, root: str, checkpoint: str, lateness: str = "10 minutes", width: str = "5 minutes", limit: float = 2.0, *, available_now: bool = True
) -> StreamingQuery:
    """Exact 95th percentile per event-time window of a stream, written when the window closes.

    How often each latency occurred in the open windows is kept in files, of which a batch adds one
    folder: a state store would hold them in the executors' memory. Folders below ``root``:
    batch_id=<n> (the windows that batch closed, replaced by a second run) and _open (the counts;
    ``vacuum`` removes what runs that broke off left there).
    """
    zero = "TIMESTAMP_NTZ'1970-01-01'"
    delay = lateness if lateness.strip().lower().startswith("interval") else f"INTERVAL {lateness}"
    micros = events.sparkSession.sql(f"SELECT {zero} + {delay} - {zero}").first()[0] // timedelta(microseconds=1)
    watched = events.withWatermark("observed_at", lateness)  # for the flow's progress reports
    writer = watched.writeStream.foreachBatch(
        lambda batch, batch_id: close_windows(batch, batch_id, latency, root, micros, width, limit)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latency_table(spark: SparkSession, root: str) -> DataFrame:
    """Closed windows of ``start_latency``; none before its first batch."""
    if not exists(spark, root):
        return spark.createDataFrame([], _LATENCY).drop("batch_id")
    return spark.read.schema(_LATENCY).option("basePath", root).parquet(root).drop("batch_id")


def windowed_growth(letters: DataFrame, lateness: str = "10 minutes", **rule) -> DataFrame:
    """Jumps in the number of dead letters of a stream with ``failed_at``."""
    return window_growth(letters, "failed_at", lateness=lateness, **rule)
