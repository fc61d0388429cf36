"""Cleaning of headers, country names and numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicora import vocab

_YEAR_HEADER = re.compile(r"(?P<year>(?:19|20)[0-9]{2})(?P<tail>.*)", re.S)
_SEX_TAIL = re.compile(r"(?P<code>[mf])(?:_(?P<copy>[0-9]+))?")
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def stripped(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def snake_case(text: object) -> str:
    """Header text to a plain identifier (plan time)."""
    return re.sub("[^a-z0-9]+", "_", str(text).strip().lower()).strip("_")


def snake_case_col(col: Column) -> Column:
    joined = F.regexp_replace(F.lower(stripped(col)), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def unique_headers(raw: list[object]) -> list[str]:
    """Clean names of one file's header; the n-th repeat of a raw name gets suffix n."""
    seen: dict[str, int] = {}
    names = []
    for position, item in enumerate(raw):
        text = "" if item is None else str(item)
        if not text.strip():
            names.append(f"unnamed_{position}")
            continue
        repeat = seen.get(text, 0)
        seen[text] = repeat + 1
        names.append(snake_case(f"{text}.{repeat}" if repeat else text))
    return names


def header_year(name: str) -> int | None:
    found = _YEAR_HEADER.match(name)
    return int(found["year"]) if found else None


def header_sex(name: str) -> str | None:
    """Sex carried by a year column; a repeated "male" column stands for female."""
    found = _YEAR_HEADER.match(name)
    tail = _SEX_TAIL.fullmatch(found["tail"]) if found else None
    if tail is None:
        return None
    return "Female" if tail["code"] == "f" or tail["copy"] == "1" else "Male"


def country_key(col: Column) -> Column:
    words = F.regexp_replace(F.lower(stripped(col)), "[^a-z0-9]+", " ")
    return F.trim(words)


def canonical_country(col: Column) -> Column:
    """Known spelling to its canonical name; anything else keeps its own text."""
    pairs = [F.lit(x) for kv in vocab.COUNTRY_SPELLINGS.items() for x in kv]
    known = F.try_element_at(F.create_map(*pairs), country_key(col))
    return F.coalesce(known, stripped(col))


def number_text(col: Column) -> Column:
    return F.nullif(F.regexp_replace(col, r"(?U)[<,\s]", ""), F.lit(""))


def number(col: Column) -> Column:
    """Number out of messy text such as ``38 000``, ``1,130.90`` or ``<500``."""
    text = number_text(col)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def indicator_of_file(name: Column) -> Column:
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    plain = snake_case_col(stem)
    pairs = [F.lit(x) for kv in vocab.INDICATOR_FILE_NAMES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), plain), plain)
