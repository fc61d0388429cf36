"""Declarative data contracts.

A contract is a list of rules; all rules of a row are evaluated in one projection and give the
array of rule names the row breaks. An empty array means the row is accepted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicora import vocab


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column
    message: str


def between(column: str, low: float, high: float) -> Rule:
    col = F.col(column)
    return Rule(
        f"{column}_range", (col >= low) & (col <= high), f"{column} must be in {low}..{high}"
    )


def at_least(column: str, low: float) -> Rule:
    return Rule(f"{column}_range", F.col(column) >= low, f"{column} must be at least {low}")


def one_of(column: str, allowed: list[str]) -> Rule:
    return Rule(f"{column}_allowed", F.col(column).isin(allowed), f"{column} is not supported")


def text_length(column: str, low: int, high: int | None = None, *, optional: bool = False) -> Rule:
    size = F.char_length(F.col(column))
    holds = size >= low if high is None else (size >= low) & (size <= high)
    if optional:
        holds = F.col(column).isNull() | holds
    return Rule(f"{column}_length", holds, f"{column} has a wrong length")


def present(column: str) -> Rule:
    return Rule(f"{column}_present", F.col(column).isNotNull(), f"{column} is missing")


def health_record(countries: list[str] = vocab.COUNTRIES) -> list[Rule]:
    return [
        one_of("country", countries),
        between("year", vocab.FIRST_YEAR, vocab.LAST_YEAR),
        text_length("indicator", 1),
        present("value"),
    ]


def sensor_event(countries: list[str] | None = vocab.COUNTRIES) -> list[Rule]:
    """``countries=None`` leaves the country rule to a join flag column ``country_known``."""
    country = (
        one_of("country", countries)
        if countries is not None
        else Rule("country_allowed", F.col("country_known"), "country is not supported")
    )
    return [
        text_length("event_id", 1),
        Rule(
            "station_id_pattern",
            F.col("station_id").rlike(vocab.STATION_PATTERN),
            "station_id has a wrong form",
        ),
        country,
        text_length("timestamp", 10),
        between("temperature_c", -20, 60),
        between("humidity_pct", 0, 100),
        at_least("rainfall_mm", 0),
    ]


def scenario(*, strict: bool = True) -> list[Rule]:
    """Disease-risk inputs; the strict variant is the narrower of the two accepted ranges."""
    temperature = (-10, 55) if strict else (-20, 60)
    rainfall = 2000 if strict else 5000
    return [
        text_length("country", 2, 80),
        one_of("disease", list(vocab.DISEASES)),
        between("temperature_c", *temperature),
        between("rainfall_mm", 0, rainfall),
        between("humidity_pct", 0, 100),
    ]


def operational_event() -> list[Rule]:
    return [
        one_of("event_type", vocab.EVENT_TYPES),
        text_length("source", 2, 100),
        one_of("status", vocab.EVENT_STATUSES),
        text_length("message", 3, 1000),
        text_length("country", 0, 100, optional=True),
        text_length("metric", 0, 100, optional=True),
    ]


def forecast_request() -> list[Rule]:
    return [
        text_length("country", 2),
        text_length("indicator", 2),
        between("horizon_years", 1, 5),
    ]


def anomaly_request() -> list[Rule]:
    return [
        text_length("country", 2),
        text_length("indicator", 2),
        between("year", vocab.FIRST_YEAR, vocab.LAST_YEAR),
        present("value"),
    ]


def acknowledgement() -> list[Rule]:
    return [text_length("owner", 2, 100), text_length("note", 0, 500, optional=True)]


def evaluation_request() -> list[Rule]:
    return [between("stale_after_hours", 1, 8760), between("anomaly_limit", 1, 100)]


def passes(rules: list[Rule]) -> Column:
    """Whether a row keeps every rule: a plain conjunction, so parts of it reach the scan."""
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & F.coalesce(rule.holds, F.lit(False))
    return verdict


def broken(rules: list[Rule]) -> Column:
    """Names of the rules a row breaks; an unknown (null) verdict counts as broken."""
    names = [F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.name)) for r in rules]
    # unlike a lambda filter, this stays inside generated code; names are distinct anyway
    return F.array_except(F.array(*names), F.array(F.lit(None).cast("string")))


def messages(rules: list[Rule], names: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.message)])
    return F.concat_ws("; ", F.transform(names, lambda n: F.element_at(lookup, n)))


def checked(df: DataFrame, rules: list[Rule], name: str = "broken_rules") -> DataFrame:
    return df.withColumn(name, broken(rules))


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    return df.where(passes(rules)), checked(df.where(~passes(rules)), rules)


def extra_columns(df: DataFrame, allowed: list[str]) -> list[str]:
    """Columns a strict contract rejects (plan time)."""
    return sorted(set(df.columns) - set(allowed))


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule_name, n) of every broken rule: one pass with one counter per rule."""
    row = df.agg(
        *[F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    )
    cells = F.array(
        *[F.struct(F.lit(r.name).alias("rule_name"), F.col(f"r{i}").alias("n")) for i, r in enumerate(rules)]
    )
    return row.select(F.inline(cells)).where("n > 0")
