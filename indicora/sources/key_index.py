"""Which keys a growing table already holds, asked without reading the table.

Keys lie in zones (a day, say, or a prefix of the key); large zones are dealt into parts by hash, at most
``PARTS``. Every batch adds a folder of its own: the keys, and marks beside them. Marks are a Bloom filter
kept as rows: a key's hash chooses a word of 64 bits and four bits in it, and a zone's words are one
``bit_or`` per word, so they are built by an ordinary aggregate that no hot zone can overload. About
eight keys share a word.

To ask, only the marks of the zones asked for are read, named by literal paths (a batch of few keys is one
file with its rows in order of zone). A key whose bits are
not all set is new for certain. Key files are opened only where some key may be known, and compared
exactly. Small folders are merged by ``compact``; batches added meanwhile stay as they are.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.sources.commits import Commits, Entry

PARTS = 64
#: Keys of a part, about, until a zone has ``PARTS`` of them.
PART_KEYS = 1 << 20
#: Batches of so few keys are one file, whatever their zones.
SMALL_KEYS = 1 << 17
#: Keys that share a word on average, at most.
KEYS_PER_WORD = 8
#: Beyond so many zones in one question their list is not made; every zone is then asked.
MOST_ZONES = 1024

_KEYS = "zone string, part int, key string, batch long"
_MARKS = "zone string, level int, word long, bits long"


def _part(parts: int = PARTS) -> Column:
    """The part of a key when a zone has this many, a power of two."""
    return F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")


def _word_at(level: str) -> Column:
    """The word of a zone's filter that a key belongs to: the low ``level`` bits of a hash."""
    last = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(level)) - 1
    return F.xxhash64(F.lit(1), "key").bitwiseAND(last)


def _bits() -> Column:
    h = F.xxhash64(F.lit(2), "key")
    places = [F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(4)]
    mask = F.lit(0).cast("long")
    for place in places:
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def zone_of_key(key: Column) -> Column:
    """A zone for keys without a natural one: 16 of them, by hash."""
    return F.substring(F.sha2(key, 256), 1, 1)


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path, Commits(spark, path)

    # --- asking
    def touched(self, zones: list[str] | None, batch: int | None = None) -> list[Entry]:
        """Entries that may hold keys of these zones; those of ``batch`` alone are left out."""
        return [
            e for e in self.log.entries()
            if e["batches"] != [[batch, batch]] and (zones is None or not e["zones"].keys().isdisjoint(zones))
        ]

    def known(self, asked: DataFrame, batch: int | None = None, kept: list[DataFrame] | None = None) -> DataFrame:
        """Rows (zone, key) of ``asked`` whose key was added in the same zone by another batch.

        Keys that pass the marks are needed here and again in the answer. With ``kept`` they are
        persisted and added to it; the caller unpersists them when the answer has been used.
        """
        asked = asked.select("zone", F.col("key").cast("string").alias("key"))
        found = [r["zone"] for r in asked.select("zone").distinct().limit(MOST_ZONES + 1).collect()]
        zones = None if len(found) > MOST_ZONES else found
        entries = self.touched(zones, batch)
        marks = self.mark_paths(entries, zones)
        if not marks:
            return self.spark.createDataFrame([], "zone string, key string")
        suspects = self._suspects(asked, entries, marks, zones)
        if kept is not None:
            kept.append(suspects.persist())
        places = suspects.select("zone", _part().alias("part")).distinct()
        wanted = None if zones is None else {(r["zone"], r["part"]) for r in places.collect()}
        paths = self.key_paths(entries, wanted)
        if not paths:
            return self.spark.createDataFrame([], "zone string, key string")
        held = self.spark.read.schema(_KEYS).parquet(*paths)
        if wanted is not None:
            held = held.where(F.col("zone").isin(sorted({z for z, _ in wanted})))
        if batch is not None:
            held = held.where(F.col("batch") != batch)
        return suspects.join(held, ["zone", "key"], "left_semi")

    def _suspects(self, asked: DataFrame, entries: list[Entry], paths: list[str], zones: list[str] | None) -> DataFrame:
        levels = sorted({e["level"] for e in entries})
        placed = asked.distinct().withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels])))
        placed = placed.withColumns({"word": _word_at("level"), "_mask": _bits()})
        marks = self.spark.read.schema(_MARKS).parquet(*paths)  # a small batch's file is pruned by its zones
        if zones is not None:
            marks = marks.where(F.col("zone").isin(zones))
        hit = F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
        return placed.join(marks, ["zone", "level", "word"]).where(hit).select("zone", "key").distinct()

    def mark_paths(self, entries: list[Entry], zones: list[str] | None) -> list[str]:
        """Mark folders of the zones asked for, in every entry that has them."""
        asked = None if zones is None else set(zones)
        out = []
        for e in entries:
            found = [z for z in sorted(e["zones"]) if asked is None or z in asked]
            out += [f"{e['folder']}/marks"] if e["small"] else [f"{e['folder']}/marks/_zone={z}" for z in found]
        return out

    def key_paths(self, entries: list[Entry], wanted: set[tuple[str, int]] | None) -> list[str]:
        """Key folders of the (zone, finest part) wanted, in every entry that has them."""
        out = []
        for e in entries:
            asked = None if wanted is None else {(z, p % e["parts"]) for z, p in wanted}
            if e["small"]:
                out += [f"{e['folder']}/keys"] if asked is None or any(z in e["zones"] for z, _ in asked) else []
                continue
            for zone, (_, held) in sorted(e["zones"].items()):
                out += [f"{e['folder']}/keys/_zone={zone}/_part={p}" for p in range(e["parts"]) if held >> p & 1 and (asked is None or (zone, p) in asked)]
        return out

    # --- adding
    def _written(self, keys: DataFrame, batches: list[list[int]]) -> Entry:
        """Write keys (zone, key, batch) and their marks into a fresh folder."""
        folder = f"{self.path}/keys-{uuid.uuid4().hex}"
        sizes = {r["zone"]: r["n"] for r in keys.groupBy("zone").agg(F.count(F.lit(1)).alias("n")).collect()}
        if odd := [z for z in sizes if z is None or not re.fullmatch(r"[\w-]+", z)]:
            raise ValueError(f"zones name folders and must be plain: {odd[:3]}")
        most = max(sizes.values(), default=0)
        parts = min(PARTS, 1 << max(0, math.ceil(math.log2(max(1, most / PART_KEYS)))))
        level = max(4, math.ceil(math.log2(max(1, most / KEYS_PER_WORD))))
        small = sum(sizes.values()) <= SMALL_KEYS
        held = dict.fromkeys(sizes, 1)
        if sizes:
            dealt = keys.withColumn("part", _part(parts)).select("zone", "part", "key", "batch")
            if small:
                dealt.coalesce(1).sortWithinPartitions("zone").write.parquet(f"{folder}/keys")
            else:
                labelled = dealt.withColumns({"_zone": F.col("zone"), "_part": F.col("part")}).hint("rebalance", "_zone", "_part")
                labelled.write.partitionBy("_zone", "_part").parquet(f"{folder}/keys")
            stored = self.spark.read.schema(_KEYS).parquet(f"{folder}/keys")
            marks = stored.withColumn("level", F.lit(level)).withColumns({"word": _word_at("level"), "_mask": _bits()})
            words = marks.groupBy("zone", "level", "word").agg(F.bit_or("_mask").alias("bits"))
            if small:
                words.coalesce(1).sortWithinPartitions("zone").write.parquet(f"{folder}/marks")
            else:
                words.withColumn("_zone", F.col("zone")).hint("rebalance", "_zone").write.partitionBy("_zone").parquet(f"{folder}/marks")
            if parts > 1:
                held = dict.fromkeys(sizes, 0)
                for r in stored.select("zone", "part").distinct().collect():
                    held[r["zone"]] |= 1 << r["part"]
        return {"folder": folder, "batches": batches, "small": small, "level": level, "parts": parts, "zones": {z: [n, held[z]] for z, n in sizes.items()}}

    def add(self, rows: DataFrame, batch: int, rows_folder: str | None = None) -> None:
        """Remember (zone, key) of a batch. Adding a batch again replaces what it added before.

        ``rows_folder``: a folder that holds the rows of these keys; it becomes visible to
        ``row_folders`` by the same commit.
        """
        keys = rows.select("zone", F.col("key").cast("string").alias("key")).distinct().withColumn("batch", F.lit(batch).cast("long"))
        entry = self._written(keys, [[batch, batch]])
        entry["rows"] = [rows_folder] if rows_folder else []

        def change(entries: list[Entry]) -> list[Entry] | None:
            others = [e for e in entries if e["batches"] != [[batch, batch]]]
            if any(a <= batch <= b for e in others for a, b in e["batches"]):
                return None  # merged meanwhile: the same keys are there already
            return [*others, entry]

        self.log.commit(change)

    def row_folders(self) -> list[str]:
        return [f for e in self.log.entries() for f in e.get("rows", [])]

    def compact(self, most_entries: int = 16) -> bool:
        """Merge all folders into one when there are more than ``most_entries``."""
        merged = self.log.entries()
        if len(merged) <= most_entries:
            return False
        paths = self.key_paths(merged, None)
        keys = self.spark.read.schema(_KEYS).parquet(*paths) if paths else self.spark.createDataFrame([], _KEYS)
        once = keys.groupBy("zone", "key").agg(F.min("batch").alias("batch"))
        base = self._written(once, _ranges([r for e in merged for r in e["batches"]]))
        base["rows"] = [f for e in merged for f in e.get("rows", [])]
        names = {e["folder"] for e in merged}

        def change(entries: list[Entry]) -> list[Entry] | None:
            if not names <= {e["folder"] for e in entries}:
                return None  # another writer replaced one of them; leave it to the next round
            return [base, *(e for e in entries if e["folder"] not in names)]

        return self.log.commit(change) is not None


def _ranges(parts: list[list[int]]) -> list[list[int]]:
    """Closed ranges, joined where they touch."""
    out: list[list[int]] = []
    for a, b in sorted(parts):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
