"""Small helpers of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicora.session import scratch_path

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_fold(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into one part. A null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part


def bounded_batches(df: DataFrame) -> DataFrame:
    """Let tasks hand Python at most some megabytes of rows at a time, however long the texts are.

    Sets two settings of the session; they hold until it ends or sets others.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return df


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the folder all executors share and read it back: cuts lineage, survives losses."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_columns(schema: T.StructType, **added: str) -> T.StructType:
    """The schema with columns added; one that exists already is replaced and moves to the end."""
    kept = [f for f in schema.fields if f.name not in added]
    extra = T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in added.items()))
    return T.StructType([*kept, *extra.fields])


def extended(batch: pa.RecordBatch, **added: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in added]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *added.values()], [*names, *added])


def per_batch(make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield from make(batch)

    return run


def lists(values, offsets, kind: pa.DataType | None = None) -> pa.Array:
    """A list array from flat values and offsets."""
    flat = pa.array(values, kind) if kind else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
