"""Store and forward: records kept while there is no connection, handed over exactly once.

Records are stored in chunks. A chunk is unsynchronised until an upload claims it for an epoch, pending
until the receiver's folder holds the epoch, and acknowledged after that. Every change of status is a
commit on the outbox's list, so two uploads never claim one chunk. An epoch is written beside the
receiver's folder and moved in by one rename: a broken-off upload is resumed under its number, and an
epoch that has arrived is not sent again, whether or not its acknowledgement was written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.scaling import constant_table
from indicora.sources.commits import Commits, Entry

UNSYNCHRONISED, PENDING, ACKNOWLEDGED = "unsynchronised", "pending", "acknowledged"
STATUSES = (UNSYNCHRONISED, PENDING, ACKNOWLEDGED)
_LINES = "value string"


class Outbox:
    """Text records on their way to the folder ``incoming``, which one outbox fills alone."""

    def __init__(self, spark: SparkSession, path: str, incoming: str):
        self.spark, self.path, self.incoming = spark, path, incoming
        self.log = Commits(spark, path)

    def store(self, records: DataFrame) -> str:
        """Keep records (column ``value``); they are safe when this returns. Returns the chunk's folder."""
        folder = f"{self.path}/chunk-{uuid.uuid4().hex}"
        records.select(F.col("value").cast("string")).write.parquet(folder)
        entry = {"folder": folder, "status": UNSYNCHRONISED, "epoch": None}
        self.log.commit(lambda entries: [*entries, entry])
        return folder

    def claim(self, most_chunks: int | None = None) -> int | None:
        """Mark waiting chunks, oldest first, as pending under a new epoch. None when none waits."""
        claimed: list[int] = []

        def change(entries: list[Entry]) -> list[Entry] | None:
            claimed.clear()
            waiting = [e["folder"] for e in entries if e["status"] == UNSYNCHRONISED][:most_chunks]
            if not waiting:
                return None
            epoch = max((e["epoch"] for e in entries if e["epoch"] is not None), default=-1) + 1
            claimed.append(epoch)
            return [e | {"status": PENDING, "epoch": epoch} if e["folder"] in waiting else e for e in entries]

        self.log.commit(change)
        return claimed[0] if claimed else None

    def arrived(self, epoch: int) -> bool:
        return self.log.exists(f"{self.incoming}/epoch={epoch}")

    def upload(self, epoch: int) -> None:
        """Move the epoch's records into the receiver's folder, unless they are there."""
        if self.arrived(epoch):
            return
        chunks = [e["folder"] for e in self.log.entries() if e["epoch"] == epoch and e["status"] == PENDING]
        if not chunks:
            raise ValueError(f"epoch {epoch} is not pending")
        staged = f"{self.incoming}/_staged-{uuid.uuid4().hex}"
        self.spark.read.schema(_LINES).parquet(*chunks).write.text(staged)
        # names with a leading underscore are not read; the rename shows all files at once
        self.log.move(staged, f"{self.incoming}/epoch={epoch}")

    def acknowledge(self, epoch: int) -> None:
        """Record that the receiver has an epoch."""
        if not self.arrived(epoch):
            raise ValueError(f"epoch {epoch} has not arrived")
        self.log.commit(lambda entries: [e | {"status": ACKNOWLEDGED} if e["epoch"] == epoch else e for e in entries])

    def pending(self) -> list[int]:
        return sorted({e["epoch"] for e in self.log.entries() if e["status"] == PENDING})

    def synchronise(self, most_chunks: int | None = None) -> list[int]:
        """Finish broken-off uploads, then hand over what waits. Returns the epochs acknowledged."""
        done: list[int] = []
        waiting = self.pending()
        while True:
            for epoch in waiting:
                self.upload(epoch)
                self.acknowledge(epoch)
                done.append(epoch)
            fresh = self.claim(most_chunks)
            if fresh is None:
                return done
            waiting = [fresh]

    def status(self) -> DataFrame:
        """One row per status: chunks and records."""
        entries = self.log.entries()
        out = constant_table(self.spark, {"status": list(STATUSES)})
        counts = None
        for status in STATUSES:
            folders = [e["folder"] for e in entries if e["status"] == status]
            if folders:
                rows = self.spark.read.schema(_LINES).parquet(*folders)
                own = rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(status).alias("status"), F.lit(len(folders)).cast("long").alias("chunks"), "records")
                counts = own if counts is None else counts.unionByName(own)
        if counts is None:
            return out.select("status", F.lit(0).cast("long").alias("chunks"), F.lit(0).cast("long").alias("records"))
        return out.join(counts, "status", "left").na.fill(0)

    def forget(self) -> None:
        """Take acknowledged chunks off the list, the last epoch's aside; ``vacuum`` then removes them."""

        def change(entries: list[Entry]) -> list[Entry] | None:
            last = max((e["epoch"] for e in entries if e["epoch"] is not None), default=None)
            kept = [e for e in entries if e["status"] != ACKNOWLEDGED or e["epoch"] == last]
            return None if len(kept) == len(entries) else kept

        self.log.commit(change)
