"""Star schema: dimensions, facts and idempotent appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions.keys import surrogate
from indicora.operators.events import observed_at
from indicora.scaling import constant_table, keep_extreme


def date_key(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyyMMdd").cast("int")


def dim_date(stamps: DataFrame, column: str) -> DataFrame:
    days = stamps.where(F.col(column).isNotNull()).select(F.to_date(column).alias("full_date"))
    return days.distinct().select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        F.quarter("full_date").alias("quarter"),
    )


def dim_country(rows: DataFrame) -> DataFrame:
    names = rows.where(F.col("country").isNotNull()).select(F.col("country").alias("country_name"))
    return names.distinct().select(surrogate(F.col("country_name")).alias("country_key"), "country_name")


def dim_indicator(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Indicators with their documentation; the unit is the first in text order."""
    codes = rows.groupBy(F.col("indicator").alias("indicator_code")).agg(F.min("unit").alias("unit"))
    labels = metadata.select(
        F.col("indicator").alias("indicator_code"), "indicator_label", "description", "source_url"
    )
    return codes.join(labels, "indicator_code", "left").withColumn(
        "indicator_key", surrogate(F.col("indicator_code"))
    )


def dim_station(events: DataFrame, arrival: list[str]) -> DataFrame:
    """Stations; when a station moved, the last event's country wins."""
    last = events.groupBy("station_id").agg(
        F.max_by("country", F.struct(*arrival)).alias("country_name")
    )
    return last.select(
        surrogate(F.col("station_id")).alias("station_key"),
        "station_id",
        surrogate(F.col("country_name")).alias("country_key"),
        "country_name",
    )


def dim_source(spark, name: str = vocab.SOURCE_TOPIC, kind: str = "stream") -> DataFrame:
    row = constant_table(spark, {"source_name": [name], "source_type": [kind]})
    return row.withColumn("source_key", surrogate(F.col("source_name")))


def dim_quality(spark) -> DataFrame:
    status, text = vocab.QUALITY_ACCEPTED
    row = constant_table(spark, {"quality_status": [status], "description": [text]})
    return row.withColumn("quality_status_key", surrogate(F.col("quality_status")))


def merged_dimension(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Insert or overwrite by key: rows of ``incoming`` win."""
    kept = existing.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def with_weather_keys(events: DataFrame) -> DataFrame:
    """Fact columns with the five dimension keys.

    A surrogate key is a hash of its natural key, so the keys are computed in place; resolving
    them needs no join and no shuffle. ``unresolved`` checks them against the dimensions.
    """
    stamp = observed_at(F.col("timestamp"))
    return events.select(
        surrogate(F.col("country")).alias("country_key"),
        surrogate(F.col("station_id")).alias("station_key"),
        date_key(stamp).alias("date_key"),
        surrogate(F.lit(vocab.SOURCE_TOPIC)).alias("source_key"),
        surrogate(F.lit(vocab.QUALITY_ACCEPTED[0])).alias("quality_status_key"),
        "event_id",
        stamp.alias("observed_at"),
        "temperature_c",
        "humidity_pct",
        "rainfall_mm",
    )


def with_health_keys(rows: DataFrame, source: str = "batch-files") -> DataFrame:
    return rows.select(
        surrogate(F.col("country")).alias("country_key"),
        surrogate(F.col("indicator")).alias("indicator_key"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("_day"),
        surrogate(F.lit(source)).alias("source_key"),
        surrogate(F.lit(vocab.QUALITY_ACCEPTED[0])).alias("quality_status_key"),
        "year",
        "sub_indicator",
        "sex",
        "unit",
        "value",
    ).withColumn("date_key", date_key(F.col("_day"))).drop("_day")


def unresolved(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    return fact.join(dimension.select(key), key, "left_anti")


def new_rows(
    incoming: DataFrame, existing: DataFrame | None, key: list[Column], order: Column
) -> DataFrame:
    """First incoming row per natural key that the target does not hold yet.

    Copies inside the batch are combined before the target is looked at, so a hot key costs one
    row per map task. Keys are compared null-safe through their text form.
    """
    names = [f"_k{i}" for i in range(len(key))]
    keyed = incoming
    for name, col in zip(names, key):
        keyed = keyed.withColumn(name, F.coalesce(col.cast("string"), F.lit("")))
    first = keep_extreme(keyed, names, order)
    if existing is not None:
        held = existing.select(
            *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, key)]
        )
        first = first.join(held, names, "left_anti")
    return first.drop(*names)


def load_counts(
    incoming: DataFrame, existing: DataFrame | None, key: str
) -> DataFrame:
    """(input, inserted, duplicates) of an idempotent append, from grouped keys only."""
    groups = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if existing is None:
        marked = groups.withColumn("_held", F.lit(False))
    else:
        held = existing.select(F.col(key).alias("_e")).distinct()
        marked = groups.join(held, F.col(key) == F.col("_e"), "left").withColumn(
            "_held", F.col("_e").isNotNull()
        )
    inserted = F.count_if(~F.col("_held"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return marked.agg(
        total.alias("input"), inserted.alias("inserted"), (total - inserted).alias("duplicates")
    )
