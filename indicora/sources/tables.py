"""Typed scans and safe writes of the engine's own tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicora import schemas
from indicora.functions.text import stripped
from indicora.operators.profile import REQUIRED
from indicora.operators.warehouse import new_rows
from indicora.scaling import nulls_last_key
from indicora.sources.commits import Commits


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def typed_long_table(raw: DataFrame) -> DataFrame:
    """Enforce the long-table types: trimmed names, numeric year and value, no null keys."""
    missing = sorted(set(REQUIRED) - set(raw.columns))
    if missing:
        raise ValueError(f"long table is missing columns: {missing}")
    optional = [c for c in ("sub_indicator", "sex", "unit") if c in raw.columns]
    typed = raw.select(
        stripped(F.col("country").cast("string")).alias("country"),
        F.col("year").cast("string").try_cast("double").cast("int").alias("year"),
        stripped(F.col("indicator").cast("string")).alias("indicator"),
        *[F.col(c).cast("string").alias(c) for c in optional],
        F.col("value").cast("string").try_cast("double").alias("value"),
    )
    return typed.dropna(subset=REQUIRED)


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.LONG_TABLE])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    return typed_long_table(raw)


def read_long_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LONG_TABLE).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Indicator documentation; an absent file gives an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.METADATA)
    reader = spark.read.schema(schemas.METADATA)
    if path.endswith(".csv"):
        return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return reader.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a new version and then publish it under the next number.

    The version appears only when the job has committed; a failed job leaves the previous one in
    place. Two writers at a time both publish, one after the other. Returns the folder written.
    """
    version = f"{path}/v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    Commits(df.sparkSession, path).commit(lambda _: [{"folder": version}])
    return version


def current_version(spark: SparkSession, path: str, number: int | None = None) -> str | None:
    """Folder of the newest version, or of an older one by its number; None before the first."""
    entries = Commits(spark, path).entries(number)
    return entries[-1]["folder"] if entries else None


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append one row for every key that the table does not hold; calling twice changes nothing.

    Of rows that share a key the smallest stays, by all columns in their order; rows without a key
    share the empty one.
    """
    spark = df.sparkSession
    held = spark.read.schema(df.schema).parquet(path) if exists(spark, path) else None
    fresh = new_rows(df, held, [F.col(key)], nulls_last_key(*df.columns))
    fresh.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append rows to a relational table as they are; choose them with ``warehouse.new_rows``."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(
        "append"
    ).save()
