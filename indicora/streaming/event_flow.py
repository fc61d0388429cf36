"""Continuous event intake: every micro-batch is routed by the batch operators.

Folders below ``root``: accepted, duplicate, retry, dlq. Each micro-batch owns
``<folder>/batch_id=<n>`` and overwrites it, so running a batch again replaces its own output.
Fingerprints of accepted events are remembered in ``ledger``, an index by event day: a batch reads
the filters of its own days and opens key files only where an event may be known. A batch that
breaks off between its output and the ledger runs again and replaces both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from indicora import vocab
from indicora.functions.keys import event_fingerprint
from indicora.operators import events
from indicora.operators.contracts import Rule, passes
from indicora.sources import json_lines
from indicora.sources.key_index import KeyIndex
from indicora.sources.tables import exists
from indicora.streaming.outbox import Outbox

#: Folders of fingerprints that a batch may have to look into; more are merged.
LEDGER_FOLDERS = 16

_ACCEPTED = (
    "fingerprint string, event_id string, station_id string, country string, timestamp string, "
    "temperature_c double, humidity_pct double, rainfall_mm double, batch_id long, event_day string"
)
_RETRY = (
    "raw string, event_id string, station_id string, country string, timestamp string, "
    "temperature_c double, humidity_pct double, rainfall_mm double, retry_count int, "
    "next_attempt_at timestamp, place string, batch_id long"
)
_DEAD = (
    "original_payload string, error_type string, error_message string, retry_count int, "
    "failed_at timestamp, source_topic string, batch_id long"
)
_SCHEMAS = {"accepted": _ACCEPTED, "duplicate": _ACCEPTED, "retry": _RETRY, "dlq": _DEAD}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = f"{root}/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], _SCHEMAS[name])
    return spark.read.schema(_SCHEMAS[name]).option("basePath", path).parquet(path)


def ledger(spark: SparkSession, root: str) -> KeyIndex:
    """Fingerprints of accepted events. They cover the event time, so equal ones share their day."""
    return KeyIndex(spark, f"{root}/ledger")


def route_batch(
    lines: DataFrame, batch_id: int, root: str, rules: list[Rule], failed_at: Column | None = None
) -> None:
    """Route one micro-batch of numbered lines and write its four outputs."""
    spark = lines.sparkSession
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    parsed = json_lines.parsed(lines).withColumn("event_day", events.event_day(F.col("timestamp")))
    parsed = parsed.persist()
    if parsed.isEmpty():
        parsed.unpersist()
        return
    book = ledger(spark, root)
    valid = parsed.where(passes(rules)).select(F.col("event_day").alias("zone"), event_fingerprint().alias("key"))
    known = book.known(valid, batch_id, kept := [])
    marked = events.routed(
        parsed,
        rules,
        json_lines.ARRIVAL,
        accepted_before=known.select(F.col("key").alias("fingerprint")),
        hopeless=F.col("malformed"),
    ).persist()
    try:
        def write(df: DataFrame, name: str, *parts: str) -> None:
            writer = df.write.mode("overwrite")
            if parts:
                writer = writer.partitionBy(*parts)
            writer.parquet(f"{root}/{name}/batch_id={batch_id}")

        for outcome in ("accepted", "duplicate"):
            rows = marked.where(F.col("outcome") == outcome).select("fingerprint", *events.EVENT_COLUMNS, "event_day")
            write(rows.hint("rebalance", "event_day"), outcome, "event_day")  # not one small file per task and day
        place = F.concat_ws("#", "file_path", "block", "row")
        again = events.retries(
            marked.withColumn("place", place), failed_at, keep=["raw", "place"]
        )
        write(again, "retry")
        write(events.dead_letters(marked, rules, failed_at), "dlq")
        first = marked.where("outcome = 'accepted'")
        book.add(first.select(F.col("event_day").alias("zone"), F.col("fingerprint").alias("key")), batch_id)
        book.compact(LEDGER_FOLDERS)
    finally:
        for held in (marked, parsed, *kept):
            held.unpersist()


def start(
    spark: SparkSession,
    incoming: str,
    root: str,
    checkpoint: str,
    *,
    countries: list[str] | None = None,
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Watch ``incoming`` for JSON-lines files. ``checkpoint`` and ``root`` belong together."""
    rules = json_lines.line_rules(countries)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # an outbox delivers whole folders below the one that is watched
    lines = reader.option("recursiveFileLookup", True).text(incoming).select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        numbered = json_lines.numbered(batch).where(F.trim("raw") != "")
        route_batch(numbered, batch_id, root, rules)

    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def counts(spark: SparkSession, root: str) -> DataFrame:
    """One row with the zero-filled number of events per outcome."""
    parts = [
        table(spark, root, name).select(F.lit(name).alias("outcome")) for name in vocab.OUTCOMES
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return events.outcome_counts(everything)


def replay_due(spark: SparkSession, root: str, incoming: str, now: Column) -> DataFrame:
    """Put due retries back into the incoming folder, each attempt once.

    Attempts are remembered by the place they came from in ``replayed``; the new lines carry the
    raised retry count. Returns the attempts replayed by this call. If it breaks off between lines
    and log, the lines come in once more; the ledger of fingerprints makes them duplicates.
    """
    log = f"{root}/replayed"
    own = f"{log}/replay={uuid.uuid4().hex}"
    waiting = events.due(table(spark, root, "retry"), now).withColumn(
        "attempt", F.concat_ws("#", F.col("batch_id").cast("string"), "place")
    )
    if exists(spark, log):
        done = spark.read.schema("attempt string, replayed_at timestamp").parquet(log)
        waiting = waiting.join(done.select("attempt"), "attempt", "left_anti")
    fields = F.from_json("raw", "map<string,string>")
    others = F.map_filter(fields, lambda k, v: k != "retry_count")
    line = F.to_json(
        F.map_concat(others, F.create_map(F.lit("retry_count"), F.col("retry_count").cast("string")))
    )
    chosen = waiting.select("attempt", line.alias("value")).persist()
    try:
        chosen.select("value").write.mode("append").text(incoming)
        chosen.select("attempt", now.alias("replayed_at")).write.parquet(own)
    finally:
        chosen.unpersist()
    return spark.read.schema("attempt string, replayed_at timestamp").parquet(own)



_RESOLVED = "original_payload string, resolved_at timestamp, resolution_notes string"


def resolutions(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/resolved"
    return spark.read.schema(_RESOLVED).parquet(path) if exists(spark, path) else spark.createDataFrame([], _RESOLVED)


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """The dead-letter table with ``resolved_at`` and ``resolution_notes``; letters are never removed."""
    first = resolutions(spark, root).groupBy("original_payload").agg(
        F.min_by(F.struct("resolved_at", "resolution_notes"), "resolved_at").alias("_r")
    )
    letters = table(spark, root, "dlq").join(first, "original_payload", "left")
    return letters.select(*[f.split()[0] for f in _DEAD.split(", ")], "_r.resolved_at", "_r.resolution_notes")


def replay_corrected(spark: SparkSession, root: str, outbox: Outbox, fixes: DataFrame, now: Column, note: str) -> int:
    """Send corrected dead letters back into the flow and mark them as resolved.

    ``fixes``: (original_payload, new_payload). Only unresolved letters are taken, each payload once.
    Lines go through ``outbox`` into the flow's incoming folder. A call that broke off is finished by
    the next one: its lines are under way already, and the letters it did not mark are sent again and
    found to be duplicates by the ledger. Returns the number of payloads replayed.
    """
    still = dead_letters(spark, root).where("resolved_at IS NULL").select("original_payload").distinct()
    chosen = fixes.groupBy("original_payload").agg(F.min("new_payload").alias("new_payload"))
    chosen = chosen.join(still, "original_payload", "left_semi").persist()
    try:
        n = chosen.count()
        if n:
            outbox.store(chosen.select(F.col("new_payload").alias("value")))
            outbox.synchronise()
            marks = chosen.select("original_payload", now.alias("resolved_at"), F.lit(note).alias("resolution_notes"))
            marks.write.mode("append").parquet(f"{root}/resolved")
    finally:
        chosen.unpersist()
    return n
