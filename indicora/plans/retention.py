"""Retention as a job over partitioned, versioned tables.

A table is a list of partition folders. The job counts, in one pass, how many rows of each partition must
stay. Partitions that keep all rows are left alone, those that keep none go off the list, mixed ones
are written anew with the rows that stay. The new list is published as the next version; readers of the
old one are not disturbed until ``vacuum`` removes what no kept version names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicora.sources.commits import Commits, Entry

_PART = "kept_part"


def _entries_of(spark: SparkSession, log: Commits, folder: str, schema: str, partition: str) -> list[Entry]:
    names = sorted(name for name, _ in log.names(folder) if name.startswith(f"{_PART}="))
    return [{"folder": f"{folder}/{name}", "schema": schema, "partition": partition} for name in names]


def _written(log: Commits, rows: DataFrame, path: str, partition: str) -> str:
    folder = f"{path}/rows-{uuid.uuid4().hex}"
    rows.withColumn(_PART, F.col(partition).cast("string")).write.partitionBy(_PART).parquet(folder)
    return folder


def append(df: DataFrame, path: str, partition: str) -> None:
    """Add rows to a table whose partitions are the values of column ``partition`` (a day, a month)."""
    log = Commits(df.sparkSession, path)
    fresh = _entries_of(df.sparkSession, log, _written(log, df, path, partition), df.schema.json(), partition)
    log.commit(lambda entries: [*entries, *fresh])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows of a version of the table, the newest by default."""
    entries = Commits(spark, path).entries(version)
    if not entries:
        raise FileNotFoundError(f"{path} has no rows")
    schema = T.StructType.fromJson(json.loads(entries[0]["schema"]))
    return spark.read.schema(schema).parquet(*[e["folder"] for e in entries])


def apply(spark: SparkSession, path: str, keep: Column) -> dict[str, int]:
    """Drop rows for which ``keep`` is false (null: they stay). Returns what became of the partitions.

    Rows appended while the job runs are not judged by it and stay.
    """
    log = Commits(spark, path)
    before = log.entries()
    told = {"kept": len(before), "dropped": 0, "rewritten": 0}
    if not before:
        return told
    staying = F.coalesce(keep, F.lit(True))
    schema, partition = before[0]["schema"], before[0]["partition"]
    rows = read(spark, path)
    # the folder a row lies in is its file's path without the file's name
    place = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    counts = rows.select(place.alias("place"), staying.alias("stays")).groupBy("place").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("stays").alias("staying")
    )
    judged = {r["place"].split(path, 1)[1]: (r["n"], r["staying"]) for r in counts.collect()}  # a row per partition
    at = {e["folder"]: judged.get(e["folder"].split(path, 1)[1], (0, 0)) for e in before}
    mixed = [f for f, (n, stays) in at.items() if 0 < stays < n]
    gone = {f for f, (n, stays) in at.items() if stays < n or n == 0}
    fresh: list[Entry] = []
    if mixed:
        left = spark.read.schema(rows.schema).parquet(*mixed).where(staying)
        fresh = _entries_of(spark, log, _written(log, left, path, partition), schema, partition)
    if gone:
        log.commit(lambda entries: [*(e for e in entries if e["folder"] not in gone), *fresh])
    return {"kept": len(before) - len(gone), "dropped": len(gone) - len(mixed), "rewritten": len(mixed)}
