"""Service-level rollups: requests, objectives, windowed health."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions.numbers import rounded
from indicora.functions.quantiles import exact_quantiles, magnitude_bucket
from indicora.scaling import constant_table


def path_template(path: Column) -> Column:
    """Paths of one country collapse to one route, so keys do not grow with the data."""
    return F.regexp_replace(path, "^/api/v1/countries/.*$", "/api/v1/countries/{country}/risk")


def request_rollup(requests: DataFrame) -> DataFrame:
    return requests.groupBy(
        "method", path_template(F.col("path")).alias("path"), "status_code"
    ).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("duration_seconds").alias("duration_seconds"),
    )


def objective_report(measures: DataFrame) -> DataFrame:
    """(name, value, target, ok) for every objective, from a table (name, value).

    An objective that nothing measures is reported with a null value and is not met.
    """
    targets = vocab.SLO_TARGETS
    limits = constant_table(
        measures.sparkSession,
        {
            "name": list(targets),
            "comparison": [t[0] for t in targets.values()],
            "target": [t[1] for t in targets.values()],
        },
    )
    ok = (
        F.when(F.col("comparison") == ">=", F.col("value") >= F.col("target"))
        .when(F.col("comparison") == "<=", F.col("value") <= F.col("target"))
        .otherwise(F.col("value") < F.col("target"))
    )
    return limits.join(measures, "name", "left").select(
        "name", "value", "target", F.coalesce(ok, F.lit(False)).alias("ok")
    )


def run_measures(runs: DataFrame, now: Column) -> DataFrame:
    """Measures of the run ledger as (name, value): one aggregate, then a reshape."""
    hours = (F.unix_micros(now) - F.unix_micros(F.max("completed_at"))) / F.lit(3.6e9)
    row = runs.agg(
        (F.count_if(F.col("status") == "completed") * 100.0 / F.count(F.lit(1))).alias("success"),
        hours.alias("fresh"),
        F.max(
            (F.unix_micros("completed_at") - F.unix_micros("started_at")) / F.lit(1e6)
        ).alias("latency"),
        (
            F.sum("record_count_in") - F.sum("record_count_valid")
            - F.sum("record_count_rejected") - F.sum("record_count_dlq")
        ).cast("double").alias("lost"),
    )
    pairs = [
        ("batch_success_rate_pct", "success"),
        ("freshness_hours", "fresh"),
        ("event_latency_seconds", "latency"),
        ("accepted_loss", "lost"),
    ]
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for n, c in pairs])
    return row.select(F.inline(cells))


def review_measures(letters: DataFrame, now: Column) -> DataFrame:
    """Longest time a dead letter waited for its review, in hours, as (name, value).

    ``letters``: failed_at, resolved_at; one without a review has been waiting until ``now``.
    """
    waited = F.unix_micros(F.coalesce("resolved_at", now)) - F.unix_micros("failed_at")
    return letters.agg(F.max(waited / F.lit(3.6e9)).alias("value")).select(
        F.lit("dlq_review_hours").alias("name"), "value"
    )


def window_health(
    events: DataFrame, failed: Column, width: str = "5 minutes", limit: float = 0.01
) -> DataFrame:
    """Error rate per tumbling event-time window (also valid on a stream)."""
    rate = F.col("errors") / F.col("events")
    return (
        events.groupBy(F.window("observed_at", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.count_if(failed).alias("errors"))
        .select(
            F.col("w.start").alias("window_start"),
            "events",
            "errors",
            rounded(rate, 6).alias("error_rate"),
            (rate > limit).alias("alerting"),
        )
    )


def window_latency(
    events: DataFrame, latency: str, width: str = "5 minutes", limit: float = 2.0
) -> DataFrame:
    """Exact 95th percentile per tumbling window, safe when one window holds most events."""
    placed = events.withColumn("window_start", F.window("observed_at", width).start)
    p95 = exact_quantiles(placed, ["window_start"], latency, {"p95": 0.95})
    return p95.withColumn("alerting", F.col("p95") > limit)


def window_latency_sketch(
    events: DataFrame, latency: str, width: str = "5 minutes", limit: float = 2.0, accuracy: int = 1000
) -> DataFrame:
    """95th percentile per window from a mergeable quantile sketch (also valid on a stream).

    The value returned is one of the window's own; its rank is off by at most n / ``accuracy``. A
    window's state is the sketch, of a size that follows ``accuracy`` and not the number of events.
    """
    return (
        events.groupBy(F.window("observed_at", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.percentile_approx(latency, 0.95, accuracy).alias("p95"))
        .select(F.col("w.start").alias("window_start"), "events", "p95", (F.col("p95") > limit).alias("alerting"))
    )


def latency_counts(events: DataFrame, latency: str, width: str = "5 minutes") -> DataFrame:
    """How often each latency occurs in each tumbling window (also valid on a stream).

    A hot window's rows are spread over its values. Columns: window_start, latency, n and, in microseconds,
    ends (the window's end) and latest (the newest time of these events).
    """
    return (
        events.groupBy(F.window("observed_at", width).alias("w"), F.col(latency).cast("double").alias("latency"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("observed_at").alias("latest"))
        .select(F.col("w.start").alias("window_start"), "latency", "n", F.unix_micros(F.col("w.end")).alias("ends"), F.unix_micros("latest").alias("latest"))
    )


def window_latency_of_counts(counts: DataFrame, limit: float = 2.0, p: str = "0.95") -> DataFrame:
    """Exact percentile per window from ``latency_counts``: the smallest value of rank ceil(p * n).

    Counts of the same latency add up. Nulls are events without a latency; NaN ranks last. Totals per
    magnitude find the bucket that holds the rank, and only that bucket's values are put in order, so
    no task orders a whole window.
    """
    v, far = F.col("latency"), F.lit(1 << 62)
    bucket = F.when(F.isnan(v), far + 1).when(v == float("inf"), far).when(v == float("-inf"), -far).otherwise(magnitude_bucket(v))
    valued = counts.withColumn("_b", bucket)
    totals = valued.groupBy("window_start", "_b").agg(F.sum("n").alias("_bn"))
    of_window = Window.partitionBy("window_start")
    known = F.when(F.col("_b").isNotNull(), F.col("_bn"))
    upto = F.sum(known).over(of_window.orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    ranked = totals.select(
        "window_start", F.col("_b").alias("_wb"), known.alias("_known"), F.sum("_bn").over(of_window).alias("events"),
        F.coalesce(upto, F.lit(0)).alias("_start"),
        F.ceil(F.sum(known).over(of_window).cast("decimal(20,0)") * F.lit(Decimal(p))).cast("long").alias("_rank"),
    )
    # a window without any latency keeps its row
    holds = F.when(F.col("_rank").isNull(), True).otherwise((F.col("_start") < F.col("_rank")) & (F.col("_rank") <= F.col("_start") + F.col("_known")))
    wanted = ranked.where(holds).select(F.col("window_start").alias("_w"), "_wb", "events", "_start", "_rank")
    same = (F.col("window_start") == F.col("_w")) & F.col("_b").eqNullSafe(F.col("_wb"))
    upto_value = Window.partitionBy("window_start").orderBy("latency").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = valued.join(wanted, same).withColumn("_to", F.col("_start") + F.sum("n").over(upto_value))
    at_rank = F.min(F.when(F.col("_to") >= F.col("_rank"), F.col("latency")))
    found = near.groupBy("window_start", "events").agg(at_rank.alias("p95"))
    return found.withColumn("alerting", F.col("p95") > limit)


def window_growth(
    letters: DataFrame, at: str, minutes: int = 5, look_back: int = 3, factor: float = 2.0, least: int = 10, lateness: str | None = None
) -> DataFrame:
    """Windows whose number of dead letters jumped: at least ``least``, and over ``factor`` times the
    mean of the ``look_back`` windows before, of which empty ones count as zero.

    Every letter counts for its own window and, as "before", for those that follow, so one mergeable
    aggregate decides and no ordering of windows is needed. ``lateness`` is for streams.
    """
    step = F.make_dt_interval(mins=F.lit(minutes))
    counted = letters.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(look_back))))
    counted = counted.withColumn("_at", F.col(at) + step * F.col("_ahead"))
    if lateness is not None:
        # copies lie up to look_back windows ahead of their letter
        ahead = f"{minutes * look_back} minutes"
        counted = counted.withWatermark("_at", f"{lateness} {ahead}")
    sums = counted.groupBy(F.window("_at", f"{minutes} minutes").alias("w")).agg(
        F.count_if(F.col("_ahead") == 0).alias("letters"), F.count_if(F.col("_ahead") > 0).alias("before")
    )
    grown = (F.col("letters") >= least) & (F.col("letters") * look_back > F.col("before") * factor)
    return sums.where(F.col("letters") > 0).select(
        F.col("w.start").alias("window_start"), "letters", "before", grown.alias("alerting")
    )
