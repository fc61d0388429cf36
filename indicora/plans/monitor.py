"""Current state of the pipelines turned into operational events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora.functions.numbers import rounded

# --- fixed values: wording and sources of generated events ---------------------------------------
NOT_READY = "Processed ASEAN health data is unavailable or the batch pipeline is not ready."
FAILED_EVENTS = "Streaming events failed and require retry or DLQ review."
STALE = "The processed health dataset is older than the configured freshness threshold."
BAD_QUALITY = "The processed health dataset failed one or more quality checks."
QUALITY_SOURCE, JUMP_SOURCE = "phase3_quality_service", "phase3_anomaly_service"
JUMP = "unusual year-over-year movement versus the historical series"

_SHAPE = ["event_type", "source", "status", "message", "country", "metric", "value", "threshold"]


def _event(kind: str, source: str, status: str, message: str, **cells: Column) -> list[Column]:
    fixed = {"event_type": kind, "source": source, "status": status, "message": message}
    missing = {
        "country": F.lit(None).cast("string"),
        "metric": F.lit(None).cast("string"),
        "value": F.lit(None).cast("double"),
        "threshold": F.lit(None).cast("double"),
    }
    columns = {**{k: F.lit(v) for k, v in fixed.items()}, **missing, **cells}
    return [columns[c].alias(c) for c in _SHAPE]


def pipeline_events(profile: DataFrame) -> DataFrame:
    down = profile.where(F.col("record_count") == 0)
    return down.select(*_event("pipeline_failure", "batch_pipeline", "failed", NOT_READY))


def failed_event_events(outcome_row: DataFrame) -> DataFrame:
    return outcome_row.where(F.col("dlq") > 0).select(
        *_event(
            "pipeline_failure",
            "streaming_pipeline",
            "warning",
            FAILED_EVENTS,
            metric=F.lit("failed_events"),
            value=F.col("dlq").cast("double"),
            threshold=F.lit(1.0),
        )
    )


def stale_events(age: DataFrame, limit_hours: int = 720) -> DataFrame:
    """``age``: rows with ``age_hours``."""
    return age.where(F.col("age_hours") > limit_hours).select(
        *_event(
            "data_quality",
            "batch_pipeline",
            "warning",
            STALE,
            metric=F.lit("dataset_age_hours"),
            value=rounded("age_hours", 2),
            threshold=F.lit(float(limit_hours)),
        )
    )


def quality_events(profile: DataFrame) -> DataFrame:
    problems = F.col("required_field_failures") + F.col("duplicate_records")
    return profile.where(F.col("status") != "pass").select(
        *_event(
            "data_quality",
            QUALITY_SOURCE,
            "warning",
            BAD_QUALITY,
            metric=F.lit("quality_failures"),
            value=problems.cast("double"),
            threshold=F.lit(0.0),
        )
    )


def jump_events(top_jumps: DataFrame) -> DataFrame:
    """``top_jumps``: the k strongest jumps; only the high ones raise an event."""
    return top_jumps.where(F.col("severity").isin("high", "critical")).select(
        *_event(
            "disease_risk",
            JUMP_SOURCE,
            "warning",
            JUMP,
            country=F.col("country"),
            metric=F.col("indicator"),
            value=F.col("z_score"),
            threshold=F.lit(2.5),
        )
    )


def state_events(*parts: DataFrame) -> DataFrame:
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything
