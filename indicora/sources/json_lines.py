"""Event files with one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora.operators.contracts import Rule, sensor_event
from indicora.operators.events import EVENT_COLUMNS

_KNOWN = [*EVENT_COLUMNS, "retry_count"]
ARRIVAL = ["row"]


def read_lines(spark: SparkSession, folder: str, *, stream: bool = False) -> DataFrame:
    """Non-blank lines with the place they came from. A missing folder gives no rows."""
    reader = spark.readStream if stream else spark.read
    if not stream:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.globStatus(path) is None:
            none = "raw string, file_path string, block long, row long"
            return spark.createDataFrame([], none)
    lines = reader.text(folder).select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return (lines if stream else numbered(lines)).where(F.trim("raw") != "")


def numbered(lines: DataFrame) -> DataFrame:
    """Number the lines of one scan: increasing within a file split, unique over the scan.

    The number follows from the scan's file splits, so a retried task gives the same one.
    """
    return lines.withColumn("row", F.monotonically_increasing_id())


def parsed(lines: DataFrame) -> DataFrame:
    """Event columns, coerced the way the contract allows, plus ``malformed``/``unexpected``.

    Every JSON object is read as text values first: a number sent as text is still a number,
    and unknown fields are noticed instead of ignored.
    """
    fields = F.from_json("raw", "map<string,string>")
    texts = {"event_id", "station_id", "country", "timestamp"}

    def cell(name: str):
        value = F.try_element_at("_fields", F.lit(name))
        kind = "string" if name in texts else "int" if name == "retry_count" else "double"
        return value.try_cast(kind).alias(name)

    known = F.array(*[F.lit(k) for k in _KNOWN])
    return lines.withColumn("_fields", fields).select(
        *[c for c in lines.columns],
        *[cell(name) for name in _KNOWN],
        F.col("_fields").isNull().alias("malformed"),
        F.array_except(F.map_keys("_fields"), known).alias("unexpected"),
    )


def line_rules(countries: list[str] | None = None) -> list[Rule]:
    """The sensor contract, plus what only text lines can get wrong."""
    extra = [
        Rule("well_formed", ~F.col("malformed"), "line is not a JSON object"),
        Rule("known_fields", F.size("unexpected") == 0, "line has unexpected fields"),
    ]
    return extra + (sensor_event() if countries is None else sensor_event(countries))


def tolerant(lines: DataFrame) -> DataFrame:
    """Readable objects only; anything else is skipped."""
    return parsed(lines).where(~F.col("malformed")).drop("malformed", "unexpected")
