"""State of many keys between micro-batches, of which a batch writes only what it changed.

A batch adds one folder with the newest state of the keys it changed, dealt into ``BUCKETS`` by hash;
a key whose state ended is written as gone. To look keys up, only the buckets that hold them are read,
and of all rows of a key the one of the latest batch counts. Older folders are merged by ``compact``,
which drops what is gone; folders from ``keep_from`` on stay as they are, so the newest batch can run
again from the state before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicora.sources.commits import Commits, Entry

BUCKETS = 64


class KeyedState:
    """States with the columns of ``schema``, one row per text key ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType):
        self.spark, self.path, self.key, self.schema = spark, path, key, schema
        self.log = Commits(spark, path)
        self._stored = T.StructType([*schema.fields, T.StructField("_gone", T.BooleanType()), T.StructField("_batch", T.LongType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(BUCKETS)).cast("int")

    def batches(self) -> list[int]:
        """The last batch of every folder, in order."""
        return sorted(e["batches"][1] for e in self.log.entries())

    def paths(self, before: int | None, buckets: set[int] | None) -> list[str]:
        entries = [e for e in self.log.entries() if before is None or e["batches"][1] < before]
        return [f"{e['folder']}/_bucket={b}" for e in entries for b in e["buckets"] if buckets is None or b in buckets]

    def _newest(self, paths: list[str], keys: DataFrame | None = None) -> DataFrame:
        """The latest row of every key, gone ones too; a key has one row per folder."""
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        rows = self.spark.read.schema(self._stored).parquet(*paths)
        if keys is not None:
            rows = rows.join(keys, self.key, "left_semi")
        rest = [f.name for f in self._stored.fields if f.name != self.key]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
        return last.select(self.key, "_last.*").select(*self._stored.fieldNames())

    def get(self, keys: DataFrame, before: int) -> DataFrame:
        """States of these keys as batches earlier than ``before`` left them."""
        keys = keys.select(self.key).distinct()
        buckets = {r[0] for r in keys.select(self._bucket()).distinct().collect()}
        return self._newest(self.paths(before, buckets), keys).where("NOT _gone").select(*self.schema.fieldNames())

    def all(self) -> DataFrame:
        return self._newest(self.paths(None, None)).where("NOT _gone").select(*self.schema.fieldNames())

    def _written(self, rows: DataFrame, first: int, last: int) -> Entry:
        folder = f"{self.path}/state-{uuid.uuid4().hex}"
        labelled = rows.select(*self._stored.fieldNames(), self._bucket().alias("_bucket")).hint("rebalance", "_bucket")
        labelled.write.partitionBy("_bucket").parquet(folder)
        buckets = sorted(int(name.split("=")[1]) for name, _ in self.log.names(folder) if name.startswith("_bucket="))
        return {"folder": folder, "batches": [first, last], "buckets": buckets}

    def put(self, states: DataFrame, ended: DataFrame, batch: int) -> None:
        """Write the new ``states`` and the keys whose state ``ended``; a batch put again is replaced."""
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name != self.key]
        gone = ended.select(self.key, *empty).select(*self.schema.fieldNames()).withColumn("_gone", F.lit(True))
        rows = states.select(*self.schema.fieldNames()).withColumn("_gone", F.lit(False)).unionByName(gone)
        entry = self._written(rows.withColumn("_batch", F.lit(batch).cast("long")), batch, batch)
        self.log.commit(lambda entries: [*(e for e in entries if e["batches"][0] < batch), entry])

    def compact(self, keep_from: int, most_entries: int = 8) -> bool:
        """Merge the folders of batches before ``keep_from`` when they are more than ``most_entries``."""
        merged = [e for e in self.log.entries() if e["batches"][1] < keep_from]
        if len(merged) <= most_entries:
            return False
        folders = {e["folder"] for e in merged}
        paths = [f"{e['folder']}/_bucket={b}" for e in merged for b in e["buckets"]]
        base = self._written(self._newest(paths).where("NOT _gone"), merged[0]["batches"][0], merged[-1]["batches"][1])

        def change(entries: list[Entry]) -> list[Entry] | None:
            if not folders <= {e["folder"] for e in entries}:
                return None
            return [base, *(e for e in entries if e["folder"] not in folders)]

        return self.log.commit(change) is not None
