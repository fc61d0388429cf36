"""Table profiles, validation reports, readiness and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions.numbers import rounded

REQUIRED = ["country", "year", "indicator", "value"]
OPTIONAL_KEY = ["sub_indicator", "sex"]


def natural_key(df: DataFrame) -> list[str]:
    return ["country", "year", "indicator", *[c for c in OPTIONAL_KEY if c in df.columns]]


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count): one aggregate pass, then a reshape of the single row."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in df.columns]
    )
    return row.select(F.inline(pairs))


def duplicate_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: every member of repeated keys, and extra copies only."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("all_members"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("extra_copies"),
    )


def quality_profile(df: DataFrame) -> DataFrame:
    """One row describing the long table.

    Rows are first counted per natural key, so the distinct counts and the duplicate count are
    taken from one small grouped table and the raw rows are shuffled once, already combined.
    """
    missing = F.lit(0)
    for c in REQUIRED:
        missing = missing + F.col(c).isNull().cast("long")
    groups = df.groupBy(*natural_key(df)).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(missing).alias("_missing")
    )
    row = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("record_count"),
        F.count_distinct("country").alias("country_count"),
        F.count_distinct("indicator").alias("indicator_count"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_records"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("required_field_failures"),
    )
    clean = (F.col("duplicate_records") == 0) & (F.col("required_field_failures") == 0)
    return row.withColumn("status", F.when(clean, "pass").otherwise("warning"))


def readiness(profile: DataFrame) -> DataFrame:
    checks = {
        "processed_data_available": F.col("record_count") > 0,
        "required_fields_valid": F.col("required_field_failures") == 0,
        "duplicates_absent": F.col("duplicate_records") == 0,
        "countries_available": F.col("country_count") > 0,
        "indicators_available": F.col("indicator_count") > 0,
    }
    everything = F.lit(True)
    for check in checks.values():
        everything = everything & check
    return profile.select(
        *[check.alias(name) for name, check in checks.items()],
        F.when(everything, "ready").otherwise("not_ready").alias("status"),
    )


def pipeline_status(profile: DataFrame) -> DataFrame:
    return profile.select(
        F.when(F.col("record_count") > 0, "healthy").otherwise("degraded").alias("status"),
        F.lit("ready").alias("batch_status"),
        "record_count",
        F.col("status").alias("quality_status"),
        F.col("year_max").alias("latest_data_year"),
    )


def validation_report(
    df: DataFrame,
    countries: list[str] | DataFrame = vocab.COUNTRIES,
    *,
    key: list[str] | None = None,
    nulls_in: list[str] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Findings (rule, severity, n, detail) of a long table, per ``by`` group.

    Missing required columns are an error found without touching the data. ``countries`` may be
    a one-column table instead of a list. Unsupported names get one row each: their number is
    not bounded, so they are never gathered into one list.
    """
    by = by or []
    absent = sorted(set(REQUIRED) - set(df.columns))
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    key = key or natural_key(df)
    any_null = F.lit(False)
    for c in nulls_in or df.columns:
        any_null = any_null | F.col(c).isNull()
    groups = df.groupBy(*dict.fromkeys([*by, *key])).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(any_null).alias("_nulls")
    )
    bad_year = (F.col("year") < vocab.FIRST_YEAR) | (F.col("year") > vocab.LAST_YEAR)

    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0))

    found = groups.groupBy(*by).agg(
        total(F.col("_n")).alias("_rows"),
        total(F.col("_nulls")).alias("_nulls"),
        total(F.col("_n") - 1).alias("_copies"),
        total(F.when(bad_year, F.col("_n"))).alias("_years"),
    )

    def finding(rule: str, level: str, n: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(level).alias("severity"),
            n.cast("long").alias("n"),
            detail.alias("detail"),
        )

    def counted(name: str, text: str) -> Column:
        return F.concat(F.lit("Dataset contains "), F.col(name).cast("string"), F.lit(text))

    numbers = F.array(
        finding(
            "empty", "error", F.col("_rows") == 0, F.lit("Validation failed: dataset is empty.")
        ),
        finding("nulls", "warning", F.col("_nulls"), F.lit("Dataset contains missing values.")),
        finding("duplicates", "warning", F.col("_copies"), counted("_copies", " duplicate records.")),
        finding("years", "warning", F.col("_years"), counted("_years", " records with invalid years.")),
    )
    named = groups.where(F.col("country").isNotNull()).groupBy(*by, "country").agg(
        F.sum("_n").alias("_n")
    )
    if isinstance(countries, DataFrame):
        known = countries.select(F.col(countries.columns[0]).alias("country")).distinct()
        named = named.join(known, "country", "left_anti")
    else:
        named = named.where(~F.col("country").isin(countries))
    name = F.concat(F.lit("Unsupported country names found: "), F.col("country"))
    unsupported = finding("countries", "warning", F.col("_n"), name)
    return (
        found.select(*by, F.inline(numbers))
        .where("n > 0")
        .unionByName(named.select(*by, F.inline(F.array(unsupported))))
    )


def freshness(df: DataFrame, stamp: str, now: Column, by: list[str], limit_hours: float) -> DataFrame:
    last = df.groupBy(*by).agg(F.max(stamp).alias("last_seen"))
    age = (F.unix_micros(now) - F.unix_micros(F.col("last_seen"))) / F.lit(3_600_000_000.0)
    return last.select(
        *by, "last_seen", rounded(age, 4).alias("age_hours"), (age > limit_hours).alias("stale")
    )


def table_status(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Files, bytes, rows, last change and age of a file-backed table.

    File attributes are collapsed per file before they are summed, so bytes are counted once.
    """
    now = F.current_timestamp() if now is None else now
    per_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_size").alias("bytes"),
        F.max("_metadata.file_modification_time").alias("changed"),
    )
    total = per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
        F.max("changed").alias("last_modified"),
    )
    hours = (F.unix_micros(now) - F.unix_micros(F.col("last_modified"))) / F.lit(3_600_000_000.0)
    return total.withColumn("age_hours", hours).withColumn(
        "status", F.when(F.col("files") > 0, "ready").otherwise("missing")
    )
