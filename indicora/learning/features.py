"""Model features over annual series (one row per country, indicator and year)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicora.functions.keys import table_digest
from indicora.functions.numbers import rounded
from indicora.operators.series import SERIES

ANOMALY_FEATURES = ["value_zscore", "delta_zscore", "year_scaled", "has_previous_value"]
FORECAST_NUMBERS = ["year", "lag1", "lag2", "rolling_mean_3", "rolling_std_3", "trend_delta"]


def forecast_frame(annual: DataFrame) -> DataFrame:
    """Lagged rows; ``held_out`` marks the newest row of every series. One window order."""
    order = Window.partitionBy(*SERIES).orderBy("year")
    before = order.rowsBetween(-3, -1)
    enough = F.count("value").over(before) >= 2
    return (
        annual.select(*SERIES, "year", "value")
        .withColumn("lag1", F.lag("value", 1).over(order))
        .withColumn("lag2", F.lag("value", 2).over(order))
        .withColumn("rolling_mean_3", F.when(enough, F.avg("value").over(before)))
        .withColumn(
            "rolling_std_3", F.coalesce(F.when(enough, F.stddev_pop("value").over(before)), F.lit(0.0))
        )
        .withColumn("trend_delta", F.col("lag1") - F.col("lag2"))
        .withColumn("held_out", F.lead("year").over(order).isNull())
        .dropna(subset=["lag1", "lag2", "rolling_mean_3", "value"])
    )


def holdout(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        frame.where(~F.col("held_out")).drop("held_out"),
        frame.where("held_out").drop("held_out"),
    )


def with_changes(annual: DataFrame) -> DataFrame:
    order = Window.partitionBy(*SERIES).orderBy("year")
    return annual.select(*SERIES, "year", "value").withColumn(
        "previous_value", F.lag("value").over(order)
    ).withColumn("delta", F.col("value") - F.col("previous_value"))


def _usable(spread: Column) -> Column:
    return F.when(spread > 0, spread).otherwise(1.0)


def indicator_statistics(changes: DataFrame) -> DataFrame:
    """Reference statistics, one row per indicator, with the overall year range on each."""
    everything = Window.partitionBy(F.lit(0))  # one row per indicator
    grouped = changes.groupBy("indicator").agg(
        F.avg("value").alias("value_mean"),
        _usable(F.stddev_samp("value")).alias("value_std"),
        F.count("value").alias("value_count"),
        F.coalesce(F.avg("delta"), F.lit(0.0)).alias("delta_mean"),
        _usable(F.stddev_samp("delta")).alias("delta_std"),
        F.count("delta").alias("delta_count"),
        _usable(F.stddev_pop("value")).alias("reference_std"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.min("year").alias("first_year"),
        F.max("year").alias("latest_year"),
    )
    return grouped.withColumn("year_min", F.min("first_year").over(everything)).withColumn(
        "year_max", F.max("latest_year").over(everything)
    )


def anomaly_features(changes: DataFrame, statistics: DataFrame) -> DataFrame:
    """Scaled features of records that carry ``previous_value`` (null when there is none)."""
    needed = statistics.select(
        "indicator", "value_mean", "value_std", "delta_mean", "delta_std", "year_min", "year_max"
    )
    span = F.greatest(F.col("year_max") - F.col("year_min"), F.lit(1))
    change = F.col("value") - F.col("previous_value")
    return (
        changes.join(needed, "indicator")
        .withColumn("value_zscore", (F.col("value") - F.col("value_mean")) / F.col("value_std"))
        .withColumn(
            "delta_zscore", F.coalesce((change - F.col("delta_mean")) / F.col("delta_std"), F.lit(0.0))
        )
        .withColumn("year_scaled", (F.col("year") - F.col("year_min")) / span)
        .withColumn("has_previous_value", F.col("previous_value").isNotNull().cast("double"))
        .drop(*[c for c in needed.columns if c != "indicator"])
    )


def newest_values(annual: DataFrame) -> DataFrame:
    return annual.groupBy(*SERIES).agg(F.max_by("value", "year").alias("latest_value"))


def with_previous(records: DataFrame, annual: DataFrame) -> DataFrame:
    """Fill a missing ``previous_value`` from the newest known value of the series."""
    filled = F.coalesce("previous_value", "latest_value")
    source = F.when(F.col("previous_value").isNull() & F.col("latest_value").isNotNull(), "training_baseline")
    return (
        records.join(newest_values(annual), SERIES, "left")
        .withColumn("previous_value_source", source.otherwise("request"))
        .withColumn("previous_value", filled)
        .drop("latest_value")
    )


def drift_details(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Shift of every indicator's mean. ``baseline`` comes from ``indicator_statistics``."""
    now = current.groupBy("indicator").agg(
        F.avg("value").alias("_mean"),
        F.count(F.lit(1)).alias("current_count"),
        F.max("year").alias("current_latest_year"),
    )
    then = baseline.select(
        "indicator",
        F.col("value_mean").alias("_then"),
        F.col("reference_std").alias("_std"),
        F.col("value_count").alias("baseline_count"),
        F.col("latest_year").alias("baseline_latest_year"),
    )
    shift = F.abs(F.col("_mean") - F.col("_then")) / F.greatest("_std", F.lit(1e-9))
    status = (
        F.when(F.col("_then").isNull(), "new_indicator")
        .when(shift >= 1.0, "drift")
        .when(shift >= 0.5, "watch")
        .otherwise("stable")
    )
    return now.join(then, "indicator", "left").select(
        "indicator",
        status.alias("status"),
        rounded(shift, 4).alias("standardized_mean_shift"),
        "baseline_count",
        "current_count",
        "baseline_latest_year",
        "current_latest_year",
    )


def drift_summary(details: DataFrame) -> DataFrame:
    drifted = F.count_if(F.col("status").isin("drift", "new_indicator"))
    watched = F.count_if(F.col("status") == "watch")
    return details.agg(drifted.alias("drifted_indicators"), watched.alias("watched_indicators")).withColumn(
        "status",
        F.when(F.col("drifted_indicators") > 0, "drift")
        .when(F.col("watched_indicators") > 0, "watch")
        .otherwise("stable"),
    )


def largest_first(details: DataFrame) -> DataFrame:
    return details.orderBy(F.col("standardized_mean_shift").desc_nulls_last(), "indicator")


def changed_since(current: DataFrame, trained_digest: str) -> DataFrame:
    return table_digest(current).withColumn("changed", F.col("digest") != trained_digest)


def error_metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, R2, SMAPE and residual spread of (value, prediction), as aggregates."""
    error = F.col("value") - F.col("prediction")
    size = F.abs("value") + F.abs("prediction")
    smape = F.when(size > 1e-9, 2.0 * F.abs(error) / size).otherwise(0.0)
    grouped = scored.groupBy(*by) if by else scored
    rows = grouped.agg(
        F.avg(F.abs(error)).alias("_mae"),
        F.sqrt(F.avg(error * error)).alias("_rmse"),
        F.sum(error * error).alias("_sse"),
        (F.var_pop("value") * F.count("value")).alias("_sst"),
        (F.avg(smape) * 100).alias("_smape"),
        F.stddev_pop(error).alias("_spread"),
        F.count(F.lit(1)).alias("test_rows"),
    )
    fit = 1 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0))
    flat = F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("test_rows") > 1, F.coalesce(fit, flat))
    return rows.select(
        *(by or []),
        rounded("_mae", 6).alias("mae"),
        rounded("_rmse", 6).alias("rmse"),
        rounded(r2, 6).alias("r2"),
        rounded("_smape", 6).alias("smape_pct"),
        rounded("_spread", 6).alias("residual_std"),
        "test_rows",
    )


def calibrated(raw: Column, low: Column, high: Column) -> Column:
    width = F.greatest(high - low, F.lit(1e-9))
    return F.least(F.greatest((raw - low) / width * 100, F.lit(0.0)), F.lit(100.0))


def review_level(score: Column, flagged: Column) -> Column:
    return (
        F.when(flagged | (score >= 75), "high").when(score >= 45, "review").otherwise("low")
    )


def anomaly_evidence() -> Column:
    return F.array(
        F.format_string(
            "Value is %.2f standard deviations from the indicator mean.", F.abs("value_zscore")
        ),
        F.format_string(
            "Year-over-year change is %.2f standard deviations from its usual change.",
            F.abs("delta_zscore"),
        ),
    )
