"""Column expressions for bands, severities, retries and weather suitability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicora import vocab


def clamp(col: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def band(score: Column, first_cut: float, second_cut: float) -> Column:
    return (
        F.when(score < first_cut, "low").when(score < second_cut, "moderate").otherwise("high")
    )


def _disease_setting(disease: Column, position: int) -> Column:
    value = F.lit(vocab.SUITABILITY_OTHER[position])
    for name, settings in vocab.SUITABILITY.items():
        value = F.when(disease == name, F.lit(settings[position])).otherwise(value)
    return value


def suitability_parts(
    disease: Column, temperature: Column, rainfall: Column, humidity: Column
) -> list[Column]:
    best, width, full_rain, floor, span = (_disease_setting(disease, i) for i in range(5))
    return [
        F.greatest(F.lit(0.0), 1 - F.abs(temperature - best) / width),
        F.least(rainfall / full_rain, F.lit(1.0)),
        clamp((humidity - floor) / span, 0.0, 1.0),
    ]


def weather_score(parts: list[Column]) -> Column:
    weighted = [F.lit(w) * p for (w, _, _), p in zip(vocab.SUITABILITY_PARTS, parts)]
    return weighted[0] + weighted[1] + weighted[2]


def weather_evidence(parts: list[Column]) -> Column:
    found = [
        F.when(p >= limit, F.lit(text))
        for (_, limit, text), p in zip(vocab.SUITABILITY_PARTS, parts)
    ]
    return F.array_except(F.array(*found), F.array(F.lit(None).cast("string")))


def severity() -> Column:
    """Severity of an operational event (status, value, threshold, event_type columns)."""
    status, value, threshold = F.col("status"), F.col("value"), F.col("threshold")
    ratio = value / F.nullif(threshold, F.lit(0.0))
    return (
        F.when(status == "critical", "critical")
        .when((threshold == 0) & (value > 0), "high")
        .when(ratio >= 1.5, "critical")
        .when(ratio >= 1, "high")
        .when(status.isin("failed", "error"), "high")
        .when(status.isin("warning", "degraded"), "medium")
        .when(F.col("event_type").isin("climate_risk", "disease_risk"), "medium")
        .when(status.isin("recovered", "healthy", "info"), "info")
        .otherwise("low")
    )


def severity_rank(col: Column) -> Column:
    rank = F.lit(-1)
    for name, value in vocab.SEVERITIES.items():
        rank = F.when(col == name, F.lit(value)).otherwise(rank)
    return rank


def severity_of_rank(rank: Column) -> Column:
    name = F.lit("none")
    for text, value in vocab.SEVERITIES.items():
        name = F.when(rank == value, F.lit(text)).otherwise(name)
    return name


def retry_delay_seconds(retry_count: Column) -> Column:
    """Delay before the next attempt; null for a negative count, which contracts reject."""
    schedule = F.array(*[F.lit(s) for s in vocab.RETRY_DELAYS_SECONDS])
    slot = F.least(retry_count + 1, F.lit(len(vocab.RETRY_DELAYS_SECONDS)))
    return F.when(retry_count >= 0, F.element_at(schedule, slot.cast("int")))


def trend_word(change: Column, tolerance: Column) -> Column:
    return (
        F.when(change > tolerance, "increasing")
        .when(change < -tolerance, "decreasing")
        .otherwise("stable")
    )


def percent_change(change: Column, base: Column) -> Column:
    return change / F.nullif(F.abs(base), F.lit(0.0)) * 100
