"""Exact quantiles with linear interpolation, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_OCTAVE = 4096
_SHIFT = 8_000_000  # larger than STEPS_PER_OCTAVE * 1075, the widest exponent of a double


def magnitude_bucket(value: Column) -> Column:
    """Integer that never decreases as ``value`` grows; about 0.02 % wide in relative terms.

    It depends on the value alone, so every scan and every retried task agrees on it.
    """
    step = F.floor(F.log2(F.abs(F.nullif(value, F.lit(0.0)))) * STEPS_PER_OCTAVE) + _SHIFT
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, step).otherwise(-step)


def exact_quantiles(
    df: DataFrame, by: list[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Columns ``by`` + one column per named probability.

    1. Counts per magnitude bucket give each bucket's starting rank; a group has a bounded
       number of buckets whatever its row count.
    2. Only buckets that contain a wanted rank are ranked value by value, equal values together.

    Without ``by`` the wanted buckets are at most two per probability: they are broadcast, and
    only the few rows inside them are shuffled. With ``by`` the number of groups is not bounded,
    so equal values are counted first and the counts are joined by shuffle.
    """
    values = (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .select(*by, F.col(value).alias("_v"))
        .withColumn("_b", magnitude_bucket(F.col("_v")))
    )
    key = [*by, "_b"]
    rows = F.count(F.lit(1))
    if by:
        values = values.groupBy(*key, "_v").agg(rows.alias("_n"))
        buckets = values.groupBy(*key).agg(F.sum("_n").alias("_bn"))
    else:
        buckets = values.groupBy(*key).agg(rows.alias("_bn"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.select(
        *by,
        "_b",
        "_bn",
        F.coalesce(F.sum("_bn").over(upto), F.lit(0)).alias("_start"),
        F.sum("_bn").over(whole).alias("_total"),
    )
    ranks = []
    for p in probabilities.values():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        ranks += [F.floor(spot), F.ceil(spot)]
    wanted = (
        placed.withColumn("_ranks", F.array_distinct(F.array(*ranks)))
        .withColumn(
            "_ranks",
            F.filter("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_bn"))),
        )
        .where(F.size("_ranks") > 0)
        .select(*[F.col(c).alias(f"_w_{c}") for c in [*by, "_b"]], "_start", "_total", "_ranks")
    )
    same = F.col("_b") == F.col("_w__b")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    inside = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    if by:
        candidates = values.join(wanted, same)
    else:
        found = values.join(F.broadcast(wanted), same).groupBy("_b", "_v")
        carried = [F.first(c).alias(c) for c in ("_start", "_total", "_ranks")]
        candidates = found.agg(rows.alias("_n"), *carried)
    spotted = (
        candidates.withColumn("_from", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .withColumn(
            "_hit",
            F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_n"))),
        )
        .where(F.size("_hit") > 0)
        .select(*by, "_total", "_v", F.explode("_hit").alias("_rank"))
    )
    at_rank = spotted.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"),
        F.first("_total").alias("_total"),
    )  # at most two entries per probability

    def read(p: float) -> Column:
        spot = (F.col("_total") - 1) * F.lit(float(p))
        low = F.element_at("_at", F.floor(spot))
        high = F.element_at("_at", F.ceil(spot))
        return low + (high - low) * (spot - F.floor(spot))

    return at_rank.select(*by, *[read(p).alias(name) for name, p in probabilities.items()])
