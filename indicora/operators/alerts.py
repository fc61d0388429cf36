"""Alert severity, lifecycle episodes, summaries and root causes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions.keys import alert_key
from indicora.functions.scoring import severity, severity_of_rank, severity_rank
from indicora.scaling import constant_table, count_before

ORDER = ["observed_at", "event_id"]
LATEST_FIELDS = [
    "event_type",
    "severity",
    "source",
    "country",
    "metric",
    "message",
    "value",
    "threshold",
    "metadata",
]


def keyed(events: DataFrame) -> DataFrame:
    """Events with ``dedup_key``, ``severity`` and ``resolves``."""
    known = F.when(F.col("event_type").isin(vocab.EVENT_TYPES), F.col("event_type"))
    return (
        events.withColumn("dedup_key", alert_key())
        .withColumn("severity", severity())
        .withColumn("resolves", F.col("status").isin(vocab.RESOLVING_STATUSES))
        .withColumn("rule_type", F.coalesce(known, F.lit(vocab.DEFAULT_EVENT_TYPE)))
    )


def segments(events: DataFrame, slice_seconds: tuple[int, ...] = (3600, 10)) -> DataFrame:
    """Fold keyed events into alert segments (dedup_key, segment): first and last event, count.

    A resolving event ends its segment. The segment number is the count of earlier resolving
    events of the key, taken slice by slice in event time (see ``count_before``), so one noisy
    key never has to be sorted by a single task.
    """
    slices = [
        F.floor(F.unix_micros("observed_at") / F.lit(width * 1_000_000)) for width in slice_seconds
    ]
    numbered = count_before(
        events, ["dedup_key"], ORDER, F.col("resolves"), slices, "segment"
    )
    order = F.struct(*ORDER)
    newest = F.struct(*LATEST_FIELDS)
    return numbered.groupBy("dedup_key", "segment").agg(
        F.min(order).alias("first"),
        F.max(order).alias("last"),
        F.max_by(newest, order).alias("latest"),
        F.count(F.lit(1)).alias("occurrences"),
        F.bool_or("resolves").alias("resolved"),
    )


def alert_id(key: Column, first_event: Column) -> Column:
    """Stable identity of an alert: its key and the event that opened it."""
    return F.substring(F.sha2(F.concat_ws("#", key, first_event.cast("string")), 256), 1, 32)


def title_of(event_type: Column, country: Column) -> Column:
    titles = F.create_map(*[F.lit(x) for t, rule in vocab.ROOT_CAUSES.items() for x in (t, rule[0])])
    default = F.lit(vocab.ROOT_CAUSES[vocab.DEFAULT_EVENT_TYPE][0])
    text = F.coalesce(F.try_element_at(titles, event_type), default)
    named = F.nullif(country, F.lit("")).isNotNull()
    return F.when(named, F.concat_ws(": ", text, country)).otherwise(text)


def alerts_of(segment_rows: DataFrame, acknowledgements: DataFrame | None = None) -> DataFrame:
    """Alert table. ``acknowledgements``: (alert_id, owner, note, acknowledged_at).

    An acknowledgement moves an alert to "acknowledged"; a later resolving event still resolves
    it and keeps the acknowledgement.
    """
    rows = segment_rows.select(
        alert_id(F.col("dedup_key"), F.col("first.event_id")).alias("alert_id"),
        "dedup_key",
        title_of(F.col("latest.event_type"), F.col("latest.country")).alias("title"),
        F.col("latest.event_type").alias("category"),
        *[F.col(f"latest.{c}").alias(c) for c in LATEST_FIELDS if c != "event_type"],
        F.col("first.observed_at").alias("created_at"),
        F.col("last.observed_at").alias("updated_at"),
        F.col("last.observed_at").alias("last_seen_at"),
        "occurrences",
        "resolved",
    )
    if acknowledgements is None:
        status = F.when(F.col("resolved"), "resolved").otherwise("open")
        return rows.withColumn("status", status).drop("resolved")
    newest = acknowledgements.groupBy("alert_id").agg(
        F.max_by(F.struct("owner", "note", "acknowledged_at"), "acknowledged_at").alias(
            "acknowledgement"
        )
    )
    seen_after = F.col("acknowledgement.acknowledged_at") >= F.col("last_seen_at")
    status = (
        F.when(F.col("resolved") & ~F.coalesce(seen_after, F.lit(False)), "resolved")
        .when(F.col("acknowledgement").isNotNull(), "acknowledged")
        .otherwise("open")
    )
    return rows.join(newest, "alert_id", "left").withColumn("status", status).drop("resolved")


def episodes(
    events: DataFrame, acknowledgements: DataFrame | None = None
) -> DataFrame:
    return alerts_of(segments(keyed(events)), acknowledgements)


def listed(
    alerts: DataFrame,
    *,
    status: str | None = None,
    severity_name: str | None = None,
    country: str | None = None,
    limit: int = 100,
) -> DataFrame:
    found = alerts
    if status:
        found = found.where(F.col("status") == status)
    if severity_name:
        found = found.where(F.col("severity") == severity_name)
    if country:
        found = found.where(F.lower(F.coalesce("country", F.lit(""))) == country.lower())
    return found.orderBy(
        severity_rank(F.col("severity")).desc(), F.col("updated_at").desc(), "alert_id"
    ).limit(limit)


def summary(alerts: DataFrame) -> DataFrame:
    """One row: totals, counts per severity and status, worst open severity, state."""
    is_open = F.col("status") == "open"
    row = alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(is_open).alias("open_alerts"),
        *[F.count_if(F.col("severity") == s).alias(f"severity_{s}") for s in vocab.SEVERITIES],
        *[
            F.count_if(F.col("status") == s).alias(f"status_{s}")
            for s in ("open", "acknowledged", "resolved")
        ],
        F.max(F.when(is_open, severity_rank(F.col("severity")))).alias("_worst"),
    )
    return (
        row.withColumn("highest_open_severity", severity_of_rank(F.col("_worst")))
        .withColumn(
            "operational_state",
            F.when(F.col("open_alerts") > 0, "attention_required").otherwise("stable"),
        )
        .drop("_worst")
    )


def rule_table(spark) -> DataFrame:
    """Fixed root-cause rules, one row per event type."""
    rules = vocab.ROOT_CAUSES
    return constant_table(
        spark,
        {
            "rule_type": list(rules),
            "summary": [r[0] for r in rules.values()],
            "probable_causes": [
                [{"rank": i, "cause": c, "confidence": p} for i, (c, p) in enumerate(r[1], 1)]
                for r in rules.values()
            ],
            "corrective_actions": [r[2] for r in rules.values()],
            "prevention_actions": [r[3] for r in rules.values()],
        },
    )


def evidence() -> Column:
    """Evidence lines of one event, in fixed order; absent facts leave no line."""

    def line(label: str, col: Column) -> Column:
        return F.when(col.isNotNull(), F.concat(F.lit(f"{label}: "), col.cast("string")))

    facts = [
        line("Source", F.col("source")),
        line("Signal", F.col("message")),
        line("Country", F.nullif(F.col("country"), F.lit(""))),
        line("Metric", F.nullif(F.col("metric"), F.lit(""))),
        line("Observed value", F.col("value")),
        line("Threshold", F.col("threshold")),
    ]
    extras = [
        line(label, F.try_element_at(F.col("metadata"), F.lit(name)))
        for name, label in vocab.EVIDENCE_LABELS
    ]
    return F.array_except(F.array(*facts, *extras), F.array(F.lit(None).cast("string")))


def root_causes(events: DataFrame) -> DataFrame:
    """Report per event: summary, ranked causes, evidence, actions, prevention."""
    known = F.when(F.col("event_type").isin(vocab.EVENT_TYPES), F.col("event_type"))
    typed = events.withColumn("rule_type", F.coalesce(known, F.lit(vocab.DEFAULT_EVENT_TYPE)))
    rules = F.broadcast(rule_table(events.sparkSession))
    return typed.withColumn("evidence", evidence()).join(rules, "rule_type").drop("rule_type")
