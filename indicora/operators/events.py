"""Event routing: validate, fingerprint, deduplicate, retry, dead-letter, replay.

The same functions serve batch jobs and the micro-batches of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions.keys import event_fingerprint
from indicora.functions.scoring import retry_delay_seconds
from indicora.operators.contracts import Rule, broken, messages, passes

EVENT_COLUMNS = [
    "event_id",
    "station_id",
    "country",
    "timestamp",
    "temperature_c",
    "humidity_pct",
    "rainfall_mm",
]


def observed_at(col: Column) -> Column:
    """ISO-8601 text to a timestamp; null when it cannot be read."""
    return F.try_to_timestamp(col)


def event_day(col: Column) -> Column:
    return F.coalesce(F.date_format(observed_at(col), "yyyy-MM-dd"), F.lit("undated"))


def routed(
    events: DataFrame,
    rules: list[Rule],
    arrival: list[str],
    *,
    accepted_before: DataFrame | None = None,
    hopeless: Column | None = None,
    max_retries: int = vocab.MAX_RETRIES,
) -> DataFrame:
    """Add ``broken_rules``, ``fingerprint`` and ``outcome`` to every event.

    ``arrival`` orders the events and must be unique together with the fingerprint. The first
    valid event of a fingerprint is accepted unless ``accepted_before`` (the ledger, column
    ``fingerprint``) already has it. ``hopeless`` marks failures no retry can mend.

    Winners are found by an aggregate and joined back on (fingerprint, arrival). A fingerprint
    copied a billion times is combined in the map tasks and its rows stay spread over the join,
    which a ranking window per fingerprint could not do. The ledger is only asked about winners.
    """
    retry_count = F.coalesce(F.col("retry_count"), F.lit(0))
    marked = (
        events.withColumn("retry_count", retry_count)
        .withColumn("broken_rules", broken(rules))
        .withColumn("fingerprint", F.when(passes(rules), event_fingerprint()))
    )
    order = F.struct(*arrival)  # one numeric column keeps the aggregate in hash tables
    first = F.min(order) if len(arrival) > 1 else F.struct(F.min(arrival[0]).alias(arrival[0]))
    winners = (
        marked.where(F.col("fingerprint").isNotNull())
        .groupBy("fingerprint")
        .agg(first.alias("_first"))
    )
    if accepted_before is not None:
        winners = winners.join(accepted_before.select("fingerprint"), "fingerprint", "left_anti")
    winners = winners.select(
        F.col("fingerprint").alias("_fp"), *[F.col(f"_first.{c}").alias(f"_w_{c}") for c in arrival]
    )
    same = F.col("fingerprint") == F.col("_fp")
    for c in arrival:
        same = same & (F.col(c) == F.col(f"_w_{c}"))
    can_retry = (F.col("retry_count") >= 0) & (F.col("retry_count") < max_retries)
    if hopeless is not None:
        can_retry = can_retry & ~hopeless
    outcome = (
        F.when(F.col("_fp").isNotNull(), "accepted")
        .when(F.col("fingerprint").isNotNull(), "duplicate")
        .when(can_retry, "retry")
        .otherwise("dlq")
    )
    joined = marked.join(winners, same, "left").withColumn("outcome", outcome)
    return joined.drop("_fp", *[f"_w_{c}" for c in arrival])


def outcome_counts(routed_events: DataFrame) -> DataFrame:
    """One row with a zero-filled count per outcome, the total and the recovered surplus."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in vocab.OUTCOMES]
    row = routed_events.agg(F.count(F.lit(1)).alias("input"), *counts)
    return row.select(
        "input",
        *vocab.OUTCOMES,
        F.greatest(F.col("accepted") - F.col("input"), F.lit(0)).alias("recovered"),
        ((F.col("accepted") >= F.col("input")) & (F.col("dlq") >= 1)).alias("zero_data_loss"),
    )


def accepted(routed_events: DataFrame) -> DataFrame:
    rows = routed_events.where(F.col("outcome") == "accepted")
    return rows.select("fingerprint", *EVENT_COLUMNS)


def retries(
    routed_events: DataFrame, failed_at: Column, keep: list[str] | None = None
) -> DataFrame:
    """Events to try again, with the raised count and the time of the next attempt."""
    wait = F.make_dt_interval(secs=retry_delay_seconds(F.col("retry_count")).cast("decimal(18,6)"))
    return routed_events.where(F.col("outcome") == "retry").select(
        *EVENT_COLUMNS,
        (F.col("retry_count") + 1).alias("retry_count"),
        (failed_at + wait).alias("next_attempt_at"),
        *(keep or []),
    )


def payload(events: DataFrame) -> Column:
    """The text an event arrived as, or its fields as JSON when it was not text."""
    fields = F.to_json(F.struct(*EVENT_COLUMNS, "retry_count"))
    return F.coalesce("raw", fields) if "raw" in events.columns else fields


def dead_letters(
    routed_events: DataFrame,
    rules: list[Rule],
    failed_at: Column,
    topic: str = vocab.SOURCE_TOPIC,
) -> DataFrame:
    return routed_events.where(F.col("outcome") == "dlq").select(
        payload(routed_events).alias("original_payload"),
        F.lit("SchemaError").alias("error_type"),
        messages(rules, F.col("broken_rules")).alias("error_message"),
        "retry_count",
        failed_at.alias("failed_at"),
        F.lit(topic).alias("source_topic"),
    )


def due(retry_table: DataFrame, now: Column) -> DataFrame:
    """Retries whose waiting time is over."""
    return retry_table.where(F.col("next_attempt_at") <= now)


def corrected(dead_letter_table: DataFrame, fixes: DataFrame, schema: str) -> DataFrame:
    """Dead letters that got a corrected payload: ``fixes`` = (original_payload, new_payload)."""
    open_letters = dead_letter_table.where(F.col("resolved_at").isNull())
    return (
        open_letters.join(fixes, "original_payload")
        .select(F.from_json("new_payload", schema).alias("event"))
        .select("event.*")
    )


def resolved(
    dead_letter_table: DataFrame, fixes: DataFrame, now: Column, note: str
) -> DataFrame:
    """The dead-letter table with corrected letters marked as resolved."""
    fixed = fixes.select("original_payload").distinct().withColumn("_fixed", F.lit(True))
    return (
        dead_letter_table.join(fixed, "original_payload", "left")
        .withColumn("resolved_at", F.coalesce("resolved_at", F.when(F.col("_fixed"), now)))
        .withColumn("resolution_notes", F.coalesce("resolution_notes", F.when(F.col("_fixed"), F.lit(note))))
        .drop("_fixed")
    )
