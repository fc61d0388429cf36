"""Content hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def joined_text(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def event_fingerprint() -> Column:
    return F.sha2(
        joined_text(*[F.col(c) for c in ("event_id", "station_id", "country", "timestamp")]), 256
    )


def alert_key() -> Column:
    def scope(name: str, default: str) -> Column:
        return F.lower(F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default)))

    text = joined_text(
        F.col("event_type"),
        F.lower("source"),
        scope("country", "global"),
        scope("metric", "general"),
    )
    return F.substring(F.sha2(text, 256), 1, 20)


def surrogate(*natural: Column) -> Column:
    """Stable dimension key: needs no sequence, so any task can compute it."""
    return F.xxhash64(*[F.coalesce(n.cast("string"), F.lit("")) for n in natural])


def table_digest(df: DataFrame) -> DataFrame:
    """One row (rows, digest) that does not depend on row order.

    Two independent sums of row hashes are kept next to the count, so repeated rows still
    change the digest (an exclusive-or would cancel pairs).
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(df.columns)]
    row = F.concat_ws("\u0001", *cells)
    wide = "decimal(38,0)"
    summed = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(row).cast(wide)).alias("a"),
        F.sum(F.xxhash64(F.reverse(row), F.lit(1)).cast(wide)).alias("b"),
    )
    return summed.select(
        "rows", F.sha2(joined_text(F.col("rows"), F.col("a"), F.col("b")), 256).alias("digest")
    )
