"""Peer-normalised risk scores and disease risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions import scoring
from indicora.functions.numbers import rounded
from indicora.operators.series import DIMENSIONS, SERIES, latest, tie_break
from indicora.scaling import constant_table


def direction_table(spark, profile: str) -> DataFrame:
    rows = vocab.DIRECTIONS[profile]
    return constant_table(spark, {"indicator": list(rows), "direction": list(rows.values())})


def score_components(df: DataFrame, directions: DataFrame) -> DataFrame:
    """(country, indicator, latest_value, risk_contribution).

    One aggregation chain: newest row per full dimension, then per (country, indicator) both the
    mean over sub-dimensions and the newest row's value, which is what peers are compared by.
    """
    dims = [c for c in DIMENSIONS if c in df.columns]
    scored = df.join(F.broadcast(directions), "indicator")
    newest = scored.groupBy(*dims, "direction").agg(
        F.max("year").alias("year"), F.max_by("value", "year").alias("value")
    )
    order = F.struct(F.col("year").alias("y"), tie_break(newest).alias("t"))
    per_country = newest.groupBy(*SERIES, "direction").agg(
        F.avg("value").alias("latest_value"), F.max_by("value", order).alias("_peer")
    )
    peers = Window.partitionBy("indicator")  # one row per country
    low, high = F.min("_peer").over(peers), F.max("_peer").over(peers)
    spread = per_country.withColumn("_low", low).withColumn("_high", high)
    place = (F.col("latest_value") - F.col("_low")) / F.nullif(
        F.col("_high") - F.col("_low"), F.lit(0.0)
    )
    place = F.coalesce(place, F.lit(0.5))
    signed = F.when(F.col("direction") > 0, place).otherwise(1 - place)
    return spread.select(
        *SERIES,
        rounded("latest_value", 3).alias("latest_value"),
        rounded(scoring.clamp(signed * 100, 0.0, 100.0), 2).alias("risk_contribution"),
    )


def scores(components: DataFrame) -> DataFrame:
    summed = components.groupBy("country").agg(
        rounded(F.avg("risk_contribution"), 2).alias("risk_score"),
        F.count(F.lit(1)).alias("indicators_used"),
    )
    return summed.withColumn("risk_level", scoring.band(F.col("risk_score"), 34, 67))


def top_drivers(components: DataFrame, size: int = 3) -> DataFrame:
    ranked = Window.partitionBy("country").orderBy(F.col("risk_contribution").desc(), "indicator")
    return components.withColumn("driver_rank", F.row_number().over(ranked)).where(
        F.col("driver_rank") <= size
    )


def comparative_scores(df: DataFrame, directions: DataFrame) -> DataFrame:
    """The older score: higher is always worse, indicators without spread are left out."""
    scored = df.join(F.broadcast(directions.where("direction > 0").select("indicator")), "indicator")
    earliest_of_newest = F.struct((-F.col("year")).alias("y"), tie_break(df).alias("t"))
    newest = scored.groupBy(*SERIES).agg(F.min_by("value", earliest_of_newest).alias("value"))
    peers = Window.partitionBy("indicator")
    spread = newest.withColumn("_low", F.min("value").over(peers)).withColumn(
        "_span", F.max("value").over(peers) - F.min("value").over(peers)
    )
    part = rounded((F.col("value") - F.col("_low")) / F.col("_span") * 100, 1)
    summed = (
        spread.where(F.col("_span") > 0)
        .groupBy("country")
        .agg(F.avg(part).alias("_score"), F.count(F.lit(1)).alias("indicators_used"))
    )
    return summed.select(
        "country",
        rounded("_score", 1).alias("risk_score"),
        scoring.band(F.col("_score"), 33.3, 66.7).alias("risk_level"),
        "indicators_used",
    )


def disease_risk(scenarios: DataFrame, baselines: DataFrame) -> DataFrame:
    """Weather suitability blended with the country's baseline score.

    ``baselines`` has at most one row per country; adaptive execution decides by its measured size
    whether the (large) scenario side has to be shuffled.
    """
    parts = scoring.suitability_parts(
        F.col("disease"), F.col("temperature_c"), F.col("rainfall_mm"), F.col("humidity_pct")
    )
    climate = scoring.weather_score(parts)
    history = F.col("risk_score") / 100
    base = baselines.select("country", "risk_score")
    names = F.create_map(*[F.lit(x) for kv in vocab.DISEASES.items() for x in kv])
    joined = scenarios.join(base, "country").withColumn(
        "_p", scoring.clamp(F.lit(0.7) * climate + F.lit(0.3) * history, 0.0, 1.0)
    )
    level = scoring.band(F.col("_p"), 0.34, 0.67)
    kept = [c for c in scenarios.columns if c != "disease"]
    return joined.select(
        *kept,
        F.element_at(names, F.col("disease")).alias("disease"),
        rounded("_p", 4).alias("risk_probability"),
        rounded(F.col("_p") * 100, 2).alias("risk_score"),
        level.alias("risk_level"),
        rounded(climate * 100, 2).alias("climate_suitability"),
        rounded(history * 100, 2).alias("health_vulnerability"),
        scoring.weather_evidence(parts).alias("weather_evidence"),
        F.array(
            F.lit(vocab.DISEASE_ADVICE[0]),
            F.when(level == "low", vocab.DISEASE_ADVICE[2]).otherwise(vocab.DISEASE_ADVICE[1]),
        ).alias("recommendations"),
    )


__all__ = [
    "comparative_scores",
    "direction_table",
    "disease_risk",
    "latest",
    "score_components",
    "scores",
    "top_drivers",
]
