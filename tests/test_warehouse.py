from pyspark.sql import functions as F

from indicora import schemas
from indicora.functions.keys import table_digest
from indicora.operators import warehouse
from indicora.plans import star
from indicora.sources import tables

EVENT = (
    "event_id string, station_id string, country string, timestamp string, temperature_c double, "
    "humidity_pct double, rainfall_mm double, seq long"
)


def _events(spark, *rows):
    return spark.createDataFrame(
        [(e, s, c, t, 30.0, 80.0, 1.0, n) for n, (e, s, c, t) in enumerate(rows)], EVENT
    )


def test_weather_load_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    first = _events(
        spark,
        ("a", "TH-BKK-01", "Thailand", "2026-07-12T09:15:30Z"),
        ("b", "TH-BKK-01", "Laos", "2026-07-13T00:00:00Z"),
        ("a", "TH-BKK-01", "Thailand", "2026-07-12T09:15:30Z"),
    )
    assert tuple(star.load_weather(spark, first, root, ["seq"]).first()) == (3, 2, 1)
    second = _events(spark, ("b", "TH-BKK-01", "Laos", "2026-07-13T00:00:00Z"), ("c", "VN-HAN-01", "Vietnam", "2026-07-13T01:00:00Z"))
    assert tuple(star.load_weather(spark, second, root, ["seq"]).first()) == (2, 1, 1)
    facts = spark.read.parquet(f"{root}/fact_weather")
    assert facts.count() == 3
    assert {r["date_key"] for r in facts.select("date_key").collect()} == {20260712, 20260713}
    stations = spark.read.parquet(tables.current_version(spark, f"{root}/dim_station"))
    assert {r["station_id"]: r["country_name"] for r in stations.collect()} == {"TH-BKK-01": "Laos", "VN-HAN-01": "Vietnam"}
    for dim, key in (("dim_country", "country_key"), ("dim_date", "date_key"), ("dim_station", "station_key")):
        dimension = spark.read.parquet(tables.current_version(spark, f"{root}/{dim}"))
        assert warehouse.unresolved(facts, dimension, key).count() == 0


def test_health_load(spark, tmp_path):
    rows = spark.createDataFrame(
        [("Laos", 2000, "x", None, None, "u", 1.0), ("Laos", 2000, "x", None, "Male", "u", 2.0)], schemas.LONG_TABLE
    )
    metadata = spark.createDataFrame([("x", "X label", "d", "s", None, None, None, None, None)], schemas.METADATA)
    for _ in range(2):
        star.load_health(spark, rows, metadata, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/fact_health").count() == 2
    dim = spark.read.parquet(tables.current_version(spark, f"{tmp_path}/dim_indicator")).first()
    assert dim["indicator_label"] == "X label" and dim["unit"] == "u"


def test_append_new(spark, tmp_path):
    df = spark.range(5).select(F.col("id").alias("k"))
    for _ in range(2):
        tables.append_new(df, str(tmp_path / "t"), "k")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_digest(spark):
    df = spark.range(50).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    base = table_digest(df).first()
    assert table_digest(df.orderBy(F.desc("id")).repartition(5)).first() == base
    assert table_digest(df.union(df)).first() != base
    assert table_digest(df.withColumn("v", F.coalesce("v", F.lit(0)))).first()["digest"] != base["digest"]
