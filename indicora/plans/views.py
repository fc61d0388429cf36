"""The given tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora import schemas, vocab
from indicora.functions.numbers import rounded

OPS_STATUS = {
    "error": "failed",
    "signup": "recovered",
    "view": "info",
    "click": "warning",
    "purchase": "critical",
}
DIRECTIONS = {
    "1-URGENT": 1,
    "2-HIGH": 1,
    "3-MEDIUM": 1,
    "4-NOT SPECIFIED": -1,
    "5-LOW": -1,
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.GIVEN_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _orders_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    # the year limits are written as dates, so the parquet reader can skip row groups
    day = F.col("o_orderdate")
    first, after = f"{vocab.FIRST_YEAR}-01-01", f"{vocab.LAST_YEAR + 1}-01-01"
    orders = table(spark, folder, "orders").where(
        (day >= F.lit(first).cast("timestamp_ntz")) & (day < F.lit(after).cast("timestamp_ntz"))
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _named(spark: SparkSession, folder: str, df: DataFrame) -> DataFrame:
    """Nation names are added after grouping, when few rows are left."""
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return df.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).drop(
        "c_nationkey", "n_nationkey"
    )


def _grouped(spark: SparkSession, folder: str, year: Column, *extra: Column) -> DataFrame:
    grouped = (
        _orders_by_nation(spark, folder)
        .groupBy(
            "c_nationkey",
            year.alias("year"),
            F.col("o_orderpriority").alias("indicator"),
            *extra,
        )
        .agg(F.avg("o_totalprice").alias("value"))
    )
    return _named(spark, folder, grouped)


def indicator_obs(spark: SparkSession, folder: str) -> DataFrame:
    rows = _grouped(
        spark, folder, F.year("o_orderdate"), F.col("o_orderstatus").alias("sub_indicator")
    )
    return rows.select(
        "country",
        "year",
        "indicator",
        "sub_indicator",
        F.lit(None).cast("string").alias("sex"),
        F.lit("usd").alias("unit"),
        "value",
    )


def indicator_series(spark: SparkSession, folder: str) -> DataFrame:
    rows = _grouped(spark, folder, F.year("o_orderdate"))
    return rows.select("country", "indicator", "year", "value")


def monthly_series(spark: SparkSession, folder: str) -> DataFrame:
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    return _grouped(spark, folder, month).select("country", "indicator", "year", "value")


def customer_series(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum("o_totalprice").alias("value"))
    )


def sensor_events(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    events = table(spark, folder, "events")
    return events.join(nations, F.col("n_nationkey") == F.col("user_id") % 25).select(
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(
            F.lit("NA-STN-"), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0")
        ).alias("station_id"),
        "country",
        F.lit(True).alias("country_known"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("value").alias("temperature_c"),
        F.get_json_object("props", "$.k").cast("double").alias("humidity_pct"),
        F.col("value").alias("rainfall_mm"),
        (F.col("event_id") % 8).cast("int").alias("retry_count"),
    )


def sensor_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor events plus a second copy of every tenth one, numbered by copy."""
    once = sensor_events(spark, folder)
    copies = F.when(F.col("seq") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return once.withColumn("copy", F.explode(copies)).withColumn(
        "arrival", F.col("seq") * 2 + F.col("copy")
    )


def as_ops_events(events: DataFrame) -> DataFrame:
    """Operational signals of one type, so the alert key reduces to the source."""
    status = F.create_map(*[F.lit(x) for kv in OPS_STATUS.items() for x in kv])
    return events.select(
        "event_id",
        F.lit("api_health").alias("event_type"),
        F.concat(F.lit("svc"), (F.col("user_id") % 10).cast("string")).alias("source"),
        F.element_at(status, F.col("event_type")).alias("status"),
        F.concat(F.lit("signal "), F.col("event_type")).alias("message"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("metric"),
        "value",
        F.lit(100.0).alias("threshold"),
        F.col("ts").cast("timestamp").alias("observed_at"),
        F.create_map(F.lit("latency_ms"), F.col("value").cast("string")).alias("metadata"),
    )


def ops_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_ops_events(table(spark, folder, "events"))


def typed_ops_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same signals spread over all six event types."""
    types = F.array(*[F.lit(t) for t in vocab.EVENT_TYPES])
    pick = (F.col("event_id") % 6 + 1).cast("int")
    return ops_events(spark, folder).withColumn("event_type", F.element_at(types, pick))


def wide_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per nation, one text column per year, as a spreadsheet would have it."""
    rows = _grouped(spark, folder, F.year("o_orderdate"))
    # at most 201 of them by the domain rule
    years = sorted(r["year"] for r in rows.select("year").distinct().collect())
    wide = rows.groupBy("country").pivot("year", years).agg(F.sum("value"))
    return wide.select("country", *[rounded(F.col(str(y)), 2).cast("string").alias(str(y)) for y in years])
