"""Tables kept in one global order, with a directory that finds any page at once.

Rows are dealt by sampled range bounds, each range is sorted and written to a folder of its own, and the
list of ranges says how many rows each holds. Rows that tie in the order are told apart by a hash of
all their columns and then by their place, so a value that a third of all rows share still spreads
over many ranges. A page reads the ranges it lies in and no others.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicora.sources.commits import Commits

_OWN = ("_tie", "_place")


def _order(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns] + [F.col("_tie").asc(), F.col("_place").asc()]


def write_ordered(df: DataFrame, columns: list[str], path: str, rows_per_range: int = 1_000_000) -> str:
    """Write ``df`` in ascending order of ``columns``, nulls last, as the table's new version."""
    spark = df.sparkSession
    folder = f"{path}/ordered-{uuid.uuid4().hex}"
    ranges = max(1, -(-df.count() // rows_per_range))
    placed = df.withColumns({"_tie": F.xxhash64(*df.columns), "_place": F.monotonically_increasing_id()})
    order = _order(columns)
    dealt = placed.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    # the writer wants rows by range; each task has one range, so this keeps the order
    dealt.sortWithinPartitions("_range", *order).write.partitionBy("_range").parquet(folder)
    schema = T.StructType([*placed.schema.fields, T.StructField("_range", T.IntegerType())])
    counts = spark.read.schema(schema).parquet(folder).groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
    listed = [{"folder": f"{folder}/_range={r['_range']}", "n": r["n"]} for r in counts]
    entry = {"folder": folder, "ranges": listed, "order": columns, "schema": placed.schema.json()}
    Commits(spark, path).commit(lambda _: [entry])
    return folder


def _entry(spark: SparkSession, path: str) -> dict:
    entries = Commits(spark, path).entries()
    if not entries:
        raise FileNotFoundError(f"nothing was written to {path}")
    return entries[-1]


def page_ranges(spark: SparkSession, path: str, offset: int, limit: int) -> list[tuple[str, int]]:
    """Folders that rows ``offset`` to ``offset + limit`` lie in, with the rows before each."""
    out, before = [], 0
    for part in _entry(spark, path)["ranges"]:
        if before + part["n"] > offset and before < offset + limit:
            out.append((part["folder"], before))
        before += part["n"]
    return out


def read_page(spark: SparkSession, path: str, offset: int = 0, limit: int = 100) -> DataFrame:
    """One page with its ``row_number`` (from 1), in order."""
    entry = _entry(spark, path)
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    rows = spark.createDataFrame([], schema).withColumn("_before", F.lit(0).cast("long"))
    for folder, before in page_ranges(spark, path, offset, limit):
        own = spark.read.schema(schema).parquet(folder)
        rows = rows.unionByName(own.withColumn("_before", F.lit(before).cast("long")))
    inside = Window.partitionBy("_before").orderBy(*_order(entry["order"]))
    numbered = rows.withColumn("row_number", F.col("_before") + F.row_number().over(inside))
    wanted = numbered.where((F.col("row_number") > offset) & (F.col("row_number") <= offset + limit))
    return wanted.orderBy("row_number").drop(*_OWN, "_before")
