"""Record filters, pages and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora import vocab


def matching(df: DataFrame, *, year: int | None = None, **text: str | None) -> DataFrame:
    """Case-insensitive equality on text columns, exact on year; ``None`` leaves a filter out."""
    found = df
    for column, wanted in text.items():
        if wanted:
            found = found.where(F.lower(F.trim(F.col(column))) == wanted.strip().lower())
    return found if year is None else found.where(F.col("year") == year)


def page(df: DataFrame, order: list[Column], offset: int = 0, limit: int = 100) -> DataFrame:
    """One page over a total order. Spark keeps only offset+limit rows per task for this."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_with_total(
    df: DataFrame, order: list[Column], offset: int = 0, limit: int = 100
) -> DataFrame:
    """A page whose rows also carry the number of matches, counted on its own."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return page(df, order, offset, limit).withColumn("total", total)


def first_records(df: DataFrame, limit: int = 100) -> DataFrame:
    """Any ``limit`` matching records, four columns; stops scanning early."""
    return df.select("country", "year", "indicator", "value").limit(limit)


def retained(kind: str, now: Column) -> Column:
    """Whether a record must still be kept. Undated or unresolved records always are."""
    if kind == "retry":
        limit = now - F.expr(f"INTERVAL {vocab.RETENTION_RETRY_DAYS} DAYS")
        return F.coalesce(F.col("replayed_at") > limit, F.lit(True))
    months = vocab.RETENTION_MONTHS[kind]
    limit = now - F.expr(f"INTERVAL {months} MONTHS")
    if kind == "dlq":
        return F.col("resolved_at").isNull() | F.coalesce(F.col("failed_at") > limit, F.lit(True))
    stamp = "recorded_at" if kind == "metrics" else "accepted_at"
    return F.coalesce(F.col(stamp) > limit, F.lit(True))
