"""Scan of a folder of CSV files whose layout, charset and quoting are not known beforehand."""

from __future__ import annotations

import csv
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicora.functions.text import unique_headers

# --- fixed values: cell texts that mean "no value" -------------------------------------------
EMPTY_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# bytes that windows-1252 leaves undefined
_UNDEFINED_1252 = "81|8D|8F|90|9D"
# what windows-1252 puts where ISO-8859-1 has control characters
_LATIN_CONTROLS = "".join(chr(b) for b in range(0x80, 0xA0) if f"{b:02X}" not in _UNDEFINED_1252)
_WINDOWS_SIGNS = _LATIN_CONTROLS.encode("latin-1").decode("cp1252")


@dataclass(frozen=True)
class Layout:
    """Files that share header, charset and quoting are read by one plan."""

    header: tuple[str, ...]
    charset: str
    multi_line: bool


@dataclass
class Manifest:
    layouts: dict[Layout, list[str]] = field(default_factory=dict)
    rejected: dict[str, str] = field(default_factory=dict)
    files: list[str] = field(default_factory=list)


def file_name_of(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """(path, uri, length) of every CSV. Scans leave empty files out, a listing does not."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.csv")
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [
        (s.getPath().toString(), s.getPath().toUri().toString(), s.getLen())
        for s in store.globStatus(pattern)
    ]
    return sorted(found, key=lambda f: file_name_of(f[0]))


def _line_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Per file, from one splittable pass over its lines: charset, quoting, rows, width, header."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select(
        "value",
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    undefined = F.hex(F.col("value").cast("binary")).rlike(f"^(..)*({_UNDEFINED_1252})")
    valid = F.is_valid_utf8("value")
    filled = F.length(F.trim("value")) > 0
    cells = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ","))
    return lines.groupBy("uri").agg(
        F.count_if(filled).alias("filled_lines"),
        F.bool_and(valid).alias("utf8"),
        F.bool_and(valid | ~undefined).alias("windows"),
        F.bool_or(quotes % 2 == 1).alias("multi_line"),
        F.max(cells).alias("widest"),
        F.min_by(
            F.when((F.col("block") == 0) & filled, F.col("value").cast("binary")),
            F.when((F.col("block") == 0) & filled, F.col("row")),
        ).alias("header"),
    )


def _decoded(raw: bytes, charset: str) -> str:
    return raw.decode({"UTF-8": "utf-8-sig", "windows-1252": "cp1252"}.get(charset, "latin-1"))


def manifest(spark: SparkSession, folder: str, exclude: frozenset[str] = frozenset()) -> Manifest:
    """Group the folder's files by layout. One small row per file reaches the driver, which
    lists the files for the scan anyway."""
    listed = _listed(spark, folder)
    if not listed:
        raise FileNotFoundError(f"No CSV files were found inside: {folder}")
    facts = {row["uri"]: row for row in _line_facts(spark, folder).collect()}
    result = Manifest()
    for path, uri, length in listed:
        name, row = file_name_of(path), facts.get(uri)
        if name in exclude:
            continue
        result.files.append(name)
        if length == 0:
            result.rejected[name] = f"CSV file is empty: {name}"
        elif row is None or row["header"] is None:
            result.rejected[name] = f"No columns or records found in {name}"
        elif row["filled_lines"] < 2:
            result.rejected[name] = f"Dataset contains no rows: {name}"
        else:
            charset = "UTF-8" if row["utf8"] else "windows-1252" if row["windows"] else "ISO-8859-1"
            first = _decoded(bytes(row["header"]), charset)
            header = tuple(next(csv.reader([first])))
            if not row["multi_line"] and row["widest"] > len(header):
                result.rejected[name] = f"Could not parse CSV structure in {name}"
                continue
            layout = Layout(header, charset, bool(row["multi_line"]))
            result.layouts.setdefault(layout, []).append(path)
    return result


def _cell(col: Column, charset: str) -> Column:
    if charset == "windows-1252":
        col = F.translate(col, _LATIN_CONTROLS, _WINDOWS_SIGNS)
    return F.when(~F.trim(col).isin(EMPTY_CELLS), col)


def read_layout(spark: SparkSession, layout: Layout, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """Rows of one layout: text cells ``c0..cn``, the file name and the row's place in its file.

    Returns the frame and the clean name of every cell column.
    """
    cells = [f"c{i}" for i in range(len(layout.header))]
    rows = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in cells]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8" if layout.charset == "UTF-8" else "ISO-8859-1")
        .option("multiLine", layout.multi_line)
        .csv(paths)
    )
    placed = rows.select(
        *[_cell(F.col(c), layout.charset).alias(c) for c in cells],
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    decoded_name = F.url_decode(F.replace("file_name", F.lit("+"), F.lit("%2B")))
    return placed.withColumn("file_name", decoded_name), unique_headers(list(layout.header))


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, checksum): one rule for files of every size.

    Sums of two hashes of every line with its number in the file, and the number of lines. A line's
    number is the number of lines of the file's earlier blocks and its place in the block, so the
    checksum depends on the order of lines but not on where the file happens to be split.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    files = found.select(F.col("_metadata.file_path").alias("uri"), "path")  # the content is pruned
    lines = spark.read.option("pathGlobFilter", "*.csv").option("lineSep", "\n").text(folder).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("value").alias("h"),
    )
    block = Window.partitionBy("uri", "block").orderBy("row")
    placed = lines.select("uri", "block", "h", F.row_number().over(block).alias("place"))
    # a line's share is linear in the block's offset, so one sum per block is enough
    h, place = F.col("h").cast("decimal(38,0)"), F.col("place").cast("decimal(38,0)")
    small = F.pmod(F.col("h"), F.lit(1 << 31)).cast("decimal(38,0)")
    sums = placed.groupBy("uri", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum(h).alias("plain"), F.sum(small).alias("small"),
        F.sum(small * place).alias("numbered"),
    )
    earlier = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("decimal(18,0)")
    folded = (
        sums.withColumn("offset", offset)
        .groupBy("uri")
        .agg(F.sum("n").alias("n"), F.sum("plain").alias("plain"), F.sum(F.col("numbered") + F.col("small") * F.col("offset")).alias("numbered"))
    )
    text = F.concat_ws("|", F.coalesce("n", F.lit(0)), F.col("plain").cast("string"), F.col("numbered").cast("string"))
    return files.join(folded, "uri", "left").select(
        F.substring_index("path", "/", -1).alias("file_name"), F.sha2(text, 256).alias("checksum")
    )
