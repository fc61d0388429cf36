"""Series analytics over the long indicator table.

Rows are reduced to one per (country, indicator, year) before any ordered window. Years lie in
1900..2100, so a window partition holds at most 201 rows (2,412 for monthly series) however
large the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicora.functions.numbers import rounded
from indicora.functions.scoring import percent_change, trend_word
from indicora.scaling import keep_extreme, nulls_last_key

SERIES = ["country", "indicator"]
DIMENSIONS = ["country", "indicator", "sub_indicator", "sex"]


def tie_break(df: DataFrame) -> Column:
    """Order of rows that share a series and a year: sub-indicator, then sex, nulls last."""
    return nulls_last_key(*[c for c in ("sub_indicator", "sex") if c in df.columns] or [F.lit(0)])


def latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of every key."""
    order = F.struct(F.col("year").alias("y"), tie_break(df).alias("t"))
    return keep_extreme(df, keys, order, last=True)


def annual_values(df: DataFrame) -> DataFrame:
    """One value per (country, indicator, year): the last row in tie-break order."""
    key = [*SERIES, "year"]
    usable = df.dropna(subset=[*key, "value"])
    order = tie_break(df)
    return usable.groupBy(*key).agg(F.max_by("value", order).alias("value"))


def annual_means(df: DataFrame) -> DataFrame:
    key = [*SERIES, "year"]
    finite = df.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return finite.groupBy(*key).agg(F.avg("value").alias("value"))


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def peer_comparison(df: DataFrame) -> DataFrame:
    """Latest value of every country next to the spread of its peers."""
    newest = latest(df, SERIES).select(*SERIES, "year", "value")
    peers = newest.groupBy("indicator").agg(
        rounded(F.avg("value"), 3).alias("average"),
        rounded(F.min("value"), 3).alias("minimum"),
        rounded(F.max("value"), 3).alias("maximum"),
        F.count(F.lit(1)).alias("countries"),
    )
    return newest.join(peers, "indicator")


def country_profile(df: DataFrame) -> DataFrame:
    """Per country: newest year, number of indicators, newest rows as a sorted array.

    The array holds one entry per (indicator, sub-indicator, sex), a vocabulary-sized list.
    """
    dims = [c for c in DIMENSIONS if c in df.columns]
    newest = latest(df, dims)
    entry = F.struct(*[F.col(c) for c in [*dims[1:], "year", "value"]])
    return newest.groupBy("country").agg(
        F.max("year").alias("latest_year"),
        F.count_distinct("indicator").alias("indicator_count"),
        F.count(F.lit(1)).alias("series_count"),
        F.array_sort(F.collect_list(entry)).alias("data"),
    )


def trends(df: DataFrame) -> DataFrame:
    order = F.struct(F.col("year").alias("y"), tie_break(df).alias("t"))
    ends = df.groupBy(*SERIES).agg(
        F.min_by("value", order).alias("first_value"),
        F.max_by("value", order).alias("last_value"),
        F.min("year").alias("start_year"),
        F.max("year").alias("end_year"),
    )
    change = F.col("last_value") - F.col("first_value")
    tolerance = F.greatest(F.abs("first_value") * 0.01, F.lit(1e-9))
    return ends.select(
        *SERIES,
        "start_year",
        "end_year",
        trend_word(change, tolerance).alias("trend"),
        rounded(change, 3).alias("absolute_change"),
        rounded(percent_change(change, F.col("first_value")), 3).alias("percentage_change"),
    )


def yearly_jumps(df: DataFrame, threshold: float = 2.5) -> DataFrame:
    """Year-over-year movements that are unusual for their own series.

    ``df`` holds one row per (country, indicator, sub-indicator, sex, year), as the load job
    guarantees, so a series is bounded by its years.
    """
    if not 1.0 <= threshold <= 10.0:
        raise ValueError("threshold must be between 1 and 10")
    series = [c for c in DIMENSIONS if c in df.columns]
    in_order = Window.partitionBy(*series).orderBy("year")
    whole = Window.partitionBy(*series)
    change = F.col("value") - F.col("previous_value")
    moved = (
        df.where(F.col("value").isNotNull())
        .withColumn("previous_value", F.lag("value").over(in_order))
        .withColumn("_change", change)
        .withColumn("_points", F.count("value").over(whole))
        .withColumn("_mean", F.avg("_change").over(whole))
        .withColumn("_spread", F.stddev_pop("_change").over(whole))
        .where((F.col("_points") >= 4) & (F.col("_spread") > 0) & F.col("_change").isNotNull())
        .withColumn("_z", F.abs((F.col("_change") - F.col("_mean")) / F.col("_spread")))
    )
    return moved.where(F.col("_z") >= threshold).select(
        *series,
        "year",
        rounded("value", 3).alias("value"),
        rounded("previous_value", 3).alias("previous_value"),
        rounded("_change", 3).alias("absolute_change"),
        rounded(percent_change(F.col("_change"), F.col("previous_value")), 2).alias(
            "percentage_change"
        ),
        rounded("_z", 2).alias("z_score"),
        F.when(F.col("_z") >= threshold + 1, "high").otherwise("moderate").alias("severity"),
    )


def top_jumps(jumps: DataFrame, limit: int) -> DataFrame:
    keys = [F.col(c).asc_nulls_last() for c in DIMENSIONS if c in jumps.columns]
    return jumps.orderBy(F.col("z_score").desc(), *keys, "year").limit(limit)


def line_fits(df: DataFrame, keys: list[str], x: str = "year", y: str = "value") -> DataFrame:
    """Least-squares line per series; combined in the map tasks like any aggregate."""
    fit = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.max(x).alias("last_x"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.greatest(F.regr_r2(F.col(y), F.col(x)), F.lit(0.0)).alias("r_squared"),
    )
    return fit.where(F.col("points") >= 2)


def line_forecasts(df: DataFrame, directions: DataFrame, horizon: int = 3) -> DataFrame:
    """Straight-line forecast of every series. ``directions``: (indicator, direction +1/-1)."""
    if not 1 <= horizon <= 5:
        raise ValueError("horizon must be between 1 and 5")
    fits = line_fits(annual_means(df), SERIES)
    rising, falling = F.col("slope") > 1e-9, F.col("slope") < -1e-9
    worse = F.col("direction") * F.signum("slope")
    implication = (
        F.when(~(rising | falling), "neutral")
        .when(worse > 0, "worsening")
        .when(worse < 0, "improving")
        .otherwise("requires_context")
    )
    confidence = (
        F.when((F.col("points") < 5) | (F.col("r_squared") < 0.35), "low")
        .when((F.col("points") >= 8) & (F.col("r_squared") >= 0.75), "high")
        .otherwise("moderate")
    )
    return (
        fits.join(F.broadcast(directions), "indicator", "left")
        .withColumn("year", F.explode(F.sequence(F.col("last_x") + 1, F.col("last_x") + horizon)))
        .select(
            *SERIES,
            "year",
            rounded(F.col("slope") * F.col("year") + F.col("intercept"), 3).alias("predicted_value"),
            F.when(rising, "increasing").when(falling, "decreasing").otherwise("stable").alias("trend"),
            implication.alias("implication"),
            rounded("slope", 6).alias("annual_slope"),
            rounded("r_squared", 4).alias("r_squared"),
            confidence.alias("confidence"),
            F.col("points").alias("history_points"),
        )
    )


def recent_history(df: DataFrame, size: int = 5) -> DataFrame:
    """The last ``size`` observations of every series, oldest first."""
    newest_first = Window.partitionBy(*SERIES).orderBy(F.col("year").desc())
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= size)
        .groupBy(*SERIES)
        .agg(F.array_sort(F.collect_list(F.struct("year", "value"))).alias("history"))
    )


def with_names_of(requests: DataFrame, names: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Resolve user spellings of ``column``; returns (resolved, unknown)."""
    known = names.select(F.col(column).alias("_canonical")).distinct()
    match = F.lower(F.trim(F.col(column))) == F.lower(F.col("_canonical"))
    joined = requests.join(known, match, "left")
    resolved = joined.where(F.col("_canonical").isNotNull()).withColumn(column, F.col("_canonical"))
    unknown = joined.where(F.col("_canonical").isNull())
    return resolved.drop("_canonical"), unknown.drop("_canonical")
