"""Folder of indicator files to one long fact table, and the metadata table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicora import vocab
from indicora.functions import text
from indicora.operators.profile import validation_report
from indicora.scaling import constant_table, keep_extreme
from indicora.sources import csv_folder

LONG = ["country", "year", "indicator", "sub_indicator", "sex", "unit", "value"]
KEY = ["country", "year", "indicator", "sub_indicator", "sex"]
PLACE = ["file_name", "position", "block", "row"]


@dataclass
class Roles:
    """Cell columns of one layout by meaning; everything here is decided at plan time."""

    country: str
    years: list[tuple[int, str, int, str | None]]  # (position, cell, year, sex)
    year: str | None = None
    extras: dict[str, str] | None = None


class UnusableLayout(ValueError):
    pass


def _first(names: list[str], wanted: list[str]) -> int | None:
    return next((names.index(w) for w in wanted if w in names), None)


def roles_of(names: list[str]) -> Roles:
    place = _first(names, vocab.COUNTRY_HEADERS)
    if place is None:
        raise UnusableLayout(f"No country column was found. Available columns: {names}")
    years = [
        (i, f"c{i}", text.header_year(n), text.header_sex(n))
        for i, n in enumerate(names)
        if text.header_year(n) is not None
    ]
    kept = ["indicators", "unit"] if years else ["indicators", "sub_indicator", "unit", "sex"]
    extras = {n: f"c{names.index(n)}" for n in kept if n in names}
    if years:
        return Roles(f"c{place}", years, None, extras)
    year = _first(names, vocab.YEAR_HEADERS)
    if year is None:
        raise UnusableLayout(
            "Dataset must contain either wide year columns or recognizable year and value "
            f"columns. Available columns: {names}"
        )
    return Roles(f"c{place}", [], f"c{year}", extras)


def value_cells(rows: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """Per file, the cell columns that can be the value of a long file.

    A header from the known list decides alone; otherwise one aggregate counts, for every other
    column at once, whether a number occurs in it. The result has one row per file.
    """
    known = _first(names, vocab.VALUE_HEADERS)
    taken = set(vocab.NON_VALUE_HEADERS)
    used_as_country = _first(names, vocab.COUNTRY_HEADERS)
    open_cells = [
        f"c{i}"
        for i, n in enumerate(names)
        if n not in taken and i != used_as_country and not n.startswith("unnamed")
    ]
    if known is not None:
        per_file = rows.select("file_name").distinct()
        return {r["file_name"]: [f"c{known}"] for r in per_file.collect()}
    probes = [F.count(text.number(F.col(c))).alias(c) for c in open_cells]
    counted = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("_rows"), *probes)
    return {
        r["file_name"]: [c for c in open_cells if r[c] > 0] for r in counted.collect()
    }


def _sub_indicator(roles: Roles) -> Column:
    extras = roles.extras or {}
    if "indicators" in extras:
        return text.stripped(F.col(extras["indicators"]))
    return F.col(extras["sub_indicator"]) if "sub_indicator" in extras else F.lit(None).cast("string")


def _optional(roles: Roles, name: str) -> Column:
    extras = roles.extras or {}
    return F.col(extras[name]) if name in extras else F.lit(None).cast("string")


def melted(rows: DataFrame, roles: Roles) -> DataFrame:
    """Wide to long. Year, sex and column position come from the header, so each is a literal
    in the exploded array: no pattern is matched per row."""
    cells = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(year).alias("year"),
                F.lit(sex).cast("string").alias("sex"),
                F.col(cell).alias("raw_value"),
            )
            for position, cell, year, sex in roles.years
        ]
    )
    return rows.select(
        "file_name",
        "block",
        "row",
        text.canonical_country(F.col(roles.country)).alias("country"),
        _sub_indicator(roles).alias("sub_indicator"),
        _optional(roles, "unit").alias("unit"),
        F.inline(cells),
    )


def already_long(rows: DataFrame, roles: Roles, value: str) -> DataFrame:
    year = text.stripped(F.col(roles.year)).try_cast("double").cast("int")
    return rows.select(
        "file_name",
        "block",
        "row",
        text.canonical_country(F.col(roles.country)).alias("country"),
        _sub_indicator(roles).alias("sub_indicator"),
        _optional(roles, "unit").alias("unit"),
        F.lit(0).alias("position"),
        year.alias("year"),
        _optional(roles, "sex").alias("sex"),
        F.col(value).alias("raw_value"),
    )


def cleaned(rows: DataFrame) -> DataFrame:
    """Numbers and indicator names, then the domain filters."""
    return (
        rows.withColumn("value", text.number(F.col("raw_value")))
        .withColumn("indicator", text.indicator_of_file(F.col("file_name")))
        .where(F.col("country").isin(vocab.COUNTRIES))
        .where(F.col("year").between(vocab.FIRST_YEAR, vocab.LAST_YEAR))
        .where(F.col("value").isNotNull())
        .select(*LONG, *PLACE)
    )


@dataclass
class Loaded:
    """Lazy results: the long table, usable rows with their origin, cells with a value as they were
    read, and rejected files."""

    table: DataFrame
    usable: DataFrame
    raw: DataFrame
    files: list[str]
    rejected: dict[str, str]


def load_folder(spark: SparkSession, folder: str, exclude: frozenset[str] = frozenset()) -> Loaded:
    found = csv_folder.manifest(spark, folder, exclude)
    rejected = dict(found.rejected)
    parts: list[DataFrame] = []
    cells_read: list[DataFrame] = []

    def add(cells: DataFrame) -> None:
        cells_read.append(cells.where("raw_value IS NOT NULL").select("file_name"))
        parts.append(cleaned(cells))

    for layout, paths in found.layouts.items():
        rows, names = csv_folder.read_layout(spark, layout, paths)
        members = [csv_folder.file_name_of(p) for p in paths]
        try:
            roles = roles_of(names)
        except UnusableLayout as problem:
            rejected.update({m: str(problem) for m in members})
            continue
        if roles.years:
            add(melted(rows, roles))
            continue
        by_cell: dict[str, list[str]] = {}
        for name, cells in value_cells(rows, names).items():
            if len(cells) == 1:
                by_cell.setdefault(cells[0], []).append(name)
            elif cells:
                shown = [names[int(c[1:])] for c in cells]
                rejected[name] = f"Multiple possible value columns were found: {shown}"
            else:
                rejected[name] = f"No value column was found. Available columns: {names}"
        for cell, owners in by_cell.items():
            mine = [p for p in paths if csv_folder.file_name_of(p) in set(owners)]
            part_rows, _ = csv_folder.read_layout(spark, layout, mine)
            add(already_long(part_rows, roles, cell))
    if not parts:
        raise RuntimeError("ETL failed: no datasets produced usable records.")
    usable = reduce(DataFrame.unionByName, parts)
    first = keep_extreme(usable, KEY, F.struct(*PLACE))
    raw = reduce(DataFrame.unionByName, cells_read)
    return Loaded(first.select(*LONG), usable, raw, found.files, rejected)


OUTPUT_ORDER = ["indicator", "country", "year", "sub_indicator", "sex"]


def output_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in OUTPUT_ORDER]


def load_report(spark: SparkSession, loaded: Loaded) -> DataFrame:
    """(file_name, status, rows, rows_with_nulls, reason): one row per file, also rejected ones.

    Cleaned and deduplicated rows can only still lack optional cells, so the null count is the
    one validation warning left; it comes from the same pass as the row count.
    """
    first = keep_extreme(loaded.usable, ["file_name", *KEY], F.struct(*PLACE))
    any_null = F.lit(False)
    for c in LONG:
        any_null = any_null | F.col(c).isNull()
    per_file = first.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("rows_with_nulls")
    )
    listed = constant_table(
        spark,
        {
            "file_name": loaded.files,
            "rejected_because": [loaded.rejected.get(f) for f in loaded.files],
        },
    ).select("file_name", F.col("rejected_because").cast("string").alias("rejected_because"))
    empty = F.when(F.col("rows").isNull(), F.lit("no usable country-year-value records were found"))
    reason = F.coalesce("rejected_because", empty)
    return listed.join(per_file, "file_name", "left").select(
        "file_name",
        F.when(reason.isNull(), "processed").otherwise("skipped").alias("status"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("rows_with_nulls", F.lit(0)).alias("rows_with_nulls"),
        reason.alias("reason"),
    )


def load_warnings(loaded: Loaded) -> DataFrame:
    first = keep_extreme(loaded.usable, ["file_name", *KEY], F.struct(*PLACE))
    return validation_report(first.select("file_name", *LONG), by=["file_name"], nulls_in=LONG)


def metadata_table(raw: DataFrame) -> DataFrame:
    """Documentation rows, one per indicator they describe; the first row per indicator wins.

    ``raw`` carries text columns with their original headers; a ``row_number`` column, when
    present, gives the order of rows.
    """
    order_name = "row_number" if "row_number" in raw.columns else None
    counted = raw.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(raw.columns)]).first()
    chosen = []
    for i, original in enumerate(raw.columns):
        if counted[i] == 0 or original == order_name:
            continue
        name = text.snake_case(original)
        chosen.append(F.col(f"`{original}`").alias(vocab.METADATA_RENAMES.get(name, name)))
    order = F.col(order_name) if order_name else F.monotonically_increasing_id()
    table = raw.select(*chosen, order.alias("_order"))
    missing = sorted(set(vocab.METADATA_REQUIRED) - set(table.columns))
    if missing:
        raise ValueError(f"Missing metadata columns: {missing}")
    pairs = [
        x for key, names in vocab.METADATA_INDICATORS.items()
        for x in (F.lit(key), F.array(*[F.lit(n) for n in names]))
    ]
    key = text.snake_case_col(F.col("indicator_label"))
    targets = F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.array(key))
    for name in vocab.METADATA_OPTIONAL:
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast("string"))
    exploded = table.where(F.col("indicator_label").isNotNull()).select(
        F.posexplode(targets).alias("_slot", "indicator"),
        *vocab.METADATA_REQUIRED,
        *vocab.METADATA_OPTIONAL,
        "_order",
    )
    first = keep_extreme(exploded, ["indicator"], F.struct("_order", "_slot"))
    return first.select("indicator", *vocab.METADATA_REQUIRED, *vocab.METADATA_OPTIONAL)


def unseen_files(current: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose (name, checksum) the ledger does not hold."""
    return current.join(ledger.select("file_name", "checksum"), ["file_name", "checksum"], "left_anti")
