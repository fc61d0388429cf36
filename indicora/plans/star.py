"""Star-schema load jobs: dimensions first, then only the facts that are new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.operators import warehouse
from indicora.operators.events import observed_at
from indicora.scaling import constant_table, keep_extreme
from indicora.sources.key_index import KeyIndex, zone_of_key
from indicora.sources.tables import current_version, replace_table

#: Folders of keys that a load may have to look into; more are merged.
LOAD_FOLDERS = 16


def _store_dimension(spark: SparkSession, rows: DataFrame, root: str, name: str, key: str) -> None:
    """Overwrite by key into a new version of the dimension."""
    path = f"{root}/{name}"
    version = current_version(spark, path)
    if version is not None:
        rows = warehouse.merged_dimension(spark.read.parquet(version), rows, key)
    replace_table(rows, path)


def fact_index(spark: SparkSession, root: str, name: str) -> KeyIndex:
    """Keys of a fact table's rows and the folders of its loads, published together."""
    return KeyIndex(spark, f"{root}/_index/{name}")


def facts(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """All rows of complete loads; None before the first."""
    folders = fact_index(spark, root, name).row_folders()
    return spark.read.option("basePath", f"{root}/{name}").parquet(*folders) if folders else None


def _keyed(rows: DataFrame, key: list[Column]) -> DataFrame:
    """Rows with the hash of their natural key."""
    text = F.concat_ws("|", *[F.to_json(F.struct(F.coalesce(c.cast("string"), F.lit("")).alias("k"))) for c in key])
    return rows.withColumn("_key", F.sha2(text, 256))


def _load(keyed: DataFrame, order: Column, root: str, name: str, partition: str, load_id: int | None, shape) -> DataFrame:
    """Write one row for every key the table lacks. Returns (input, inserted, duplicates).

    ``keyed`` is read several times: persist it. Keys are looked up in the index, so a load reads key
    files where one of its keys may be held and no fact rows at all. Rows and keys become visible by one
    commit: a load that breaks off leaves nothing that ``facts`` reads, and one that runs again under its
    ``load_id`` replaces its own rows. A fact table is loaded by one job at a time.
    """
    spark = keyed.sparkSession
    index = fact_index(spark, root, name)
    if load_id is None:
        load_id = max((b for e in index.log.entries() for _, b in e["batches"]), default=-1) + 1
    known = index.known(keyed.select(zone_of_key(F.col("_key")).alias("zone"), F.col("_key").alias("key")), load_id, kept := [])
    new = keyed.join(known.select(F.col("key").alias("_key")), "_key", "left_anti")
    first = keep_extreme(new, ["_key"], order).persist()
    try:
        total, inserted = keyed.count(), first.count()
        folder = f"{root}/{name}/load_id={load_id}"
        if inserted:
            # not one small file per task and partition
            shape(first.drop("_key")).hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(folder)
        keys = first.select(zone_of_key(F.col("_key")).alias("zone"), F.col("_key").alias("key"))
        index.add(keys, load_id, folder if inserted else None)
    finally:
        for held in (first, *kept):
            held.unpersist()
    index.compact(LOAD_FOLDERS)
    return constant_table(spark, {"input": [total], "inserted": [inserted], "duplicates": [total - inserted]})


def load_weather(spark: SparkSession, accepted: DataFrame, root: str, arrival: list[str], load_id: int | None = None) -> DataFrame:
    """Load accepted events. Returns the (input, inserted, duplicates) row of this load."""
    keyed = _keyed(accepted, [F.col("event_id")]).persist()  # read by every dimension and by the load
    try:
        stamped = keyed.withColumn("_stamp", observed_at(F.col("timestamp")))
        dimensions = {
            "dim_country": (warehouse.dim_country(keyed), "country_key"),
            "dim_station": (warehouse.dim_station(keyed, arrival), "station_key"),
            "dim_date": (warehouse.dim_date(stamped, "_stamp"), "date_key"),
            "dim_source": (warehouse.dim_source(spark), "source_key"),
            "dim_quality_status": (warehouse.dim_quality(spark), "quality_status_key"),
        }
        for name, (rows, key) in dimensions.items():
            _store_dimension(spark, rows, root, name, key)
        return _load(keyed, F.struct(*arrival), root, "fact_weather", "date_key", load_id, warehouse.with_weather_keys)
    finally:
        keyed.unpersist()


def load_health(spark: SparkSession, rows: DataFrame, metadata: DataFrame, root: str, load_id: int | None = None) -> DataFrame:
    """Load long-table rows; a missing sub-indicator or sex counts as empty in the key."""
    _store_dimension(spark, warehouse.dim_country(rows), root, "dim_country", "country_key")
    _store_dimension(
        spark, warehouse.dim_indicator(rows, metadata), root, "dim_indicator", "indicator_key"
    )
    key = [F.col(c) for c in ("country_key", "indicator_key", "year", "sub_indicator", "sex")]
    keyed = _keyed(warehouse.with_health_keys(rows), key).persist()
    try:
        return _load(keyed, F.col("value"), root, "fact_health", "indicator_key", load_id, lambda new: new)
    finally:
        keyed.unpersist()
