"""The batch load as one job: only unseen files trigger it, and every run leaves its records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora import schemas
from indicora.operators import ordered
from indicora.plans import etl
from indicora.sources import csv_folder, tables


def _ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/processed_files"
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schemas.FILE_LEDGER)
    return spark.read.schema(schemas.FILE_LEDGER).parquet(path)


def _noted(df: DataFrame, root: str, name: str, run: str) -> None:
    """Append-only records; each run owns its folder, so running it again replaces its own."""
    df.write.mode("overwrite").parquet(f"{root}/{name}/run={run}")


def load_indicators(
    spark: SparkSession, folder: str, root: str, exclude: frozenset[str] = frozenset()
) -> str | None:
    """Rebuild the long table when the folder holds a file the ledger does not know.

    Returns the folder of the new table version, or None when nothing changed. The long table is
    partitioned by indicator and sorted inside its files; readers switch over when the write has
    committed. Written besides it: the file report, the run record and the newly processed files.
    """
    run = uuid.uuid4().hex
    fresh = etl.unseen_files(csv_folder.checksums(spark, folder), _ledger(spark, root))
    fresh = fresh.where(~F.col("file_name").isin(list(exclude) or [""]))
    new_files = fresh.collect()  # one row per new file
    if not new_files:
        return None
    started = spark.sql("SELECT current_timestamp()").first()[0]
    try:
        version = _load(spark, folder, root, exclude, run, started)
    except Exception:
        _run_record(spark, folder, root, run, started, "failed", {})
        raise
    # the ledger comes last: a crash before it makes the next run load the files again
    noted = spark.createDataFrame(new_files, fresh.schema).withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "pipeline_run_id": F.lit(run)}
    )
    noted.write.mode("append").parquet(f"{root}/processed_files")
    return version


def _load(spark: SparkSession, folder: str, root: str, exclude: frozenset[str], run: str, started) -> str:
    loaded = etl.load_folder(spark, folder, exclude)
    version = tables.replace_table(
        loaded.table.sortWithinPartitions(*etl.output_order()), f"{root}/long", ["indicator"]
    )
    _noted(etl.load_report(spark, loaded), root, "file_report", run)
    read, kept = loaded.raw.count(), spark.read.parquet(version).count()
    # records are cells with a value; unusable and repeated ones don't reach the table
    _run_record(spark, folder, root, run, started, "completed", {"in": read, "valid": kept, "rejected": read - kept})
    return version


def _run_record(
    spark: SparkSession, folder: str, root: str, run: str, started, status: str, counted: dict[str, int]
) -> None:
    """The run in the ledger, and its measures in the metrics ledger."""
    record = spark.range(1).select(
        F.lit(run).alias("pipeline_run_id"),
        F.lit("indicator_load").alias("pipeline_name"),
        F.lit(folder).alias("source_name"),
        F.lit(None).cast("string").alias("file_name"),
        *[F.lit(counted.get(k, 0)).cast("long").alias(f"record_count_{k}") for k in ("in", "valid", "rejected", "dlq")],
        F.lit(started).alias("started_at"),
        F.current_timestamp().alias("completed_at"),
        F.lit(status).alias("status"),
        F.lit(None).cast("string").alias("checksum"),
    )
    _noted(record.select(*schemas.RUN_LEDGER.fieldNames()), root, "pipeline_runs", run)
    seconds = (F.unix_micros("completed_at") - F.unix_micros("started_at")) / F.lit(1e6)
    values = {"records_read": ("record_count_in", "records"), "records_kept": ("record_count_valid", "records")}
    cells = [
        F.struct(F.lit(name).alias("metric_name"), F.col(c).cast("double").alias("metric_value"), F.lit(unit).alias("metric_unit"))
        for name, (c, unit) in values.items()
    ]
    took = F.struct(F.lit("duration").alias("metric_name"), seconds.alias("metric_value"), F.lit("seconds").alias("metric_unit"))
    metrics = record.select("pipeline_name", F.inline(F.array(*cells, took)), F.col("completed_at").alias("recorded_at"))
    _noted(metrics.select(*schemas.METRIC_LEDGER.fieldNames()), root, "metrics", run)


def current_long_table(spark: SparkSession, root: str) -> DataFrame:
    version = tables.current_version(spark, f"{root}/long")
    if version is None:
        raise FileNotFoundError(f"no long table has been published below {root}")
    return spark.read.schema(schemas.LONG_TABLE).parquet(version)


def publish_ordered(spark: SparkSession, root: str, rows_per_range: int = 1_000_000) -> str:
    """Write the current long table in its output order over the whole table, ready for deep pages."""
    rows = current_long_table(spark, root)
    return ordered.write_ordered(rows, etl.OUTPUT_ORDER, f"{root}/ordered", rows_per_range)
