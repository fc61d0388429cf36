import pytest
from pyspark.sql import functions as F

from indicora.functions import text


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Brunei Darussalam*", "Brunei"),
        ("Brunnei Darussalam", "Brunei"),
        ("Lao's PDR", "Laos"),
        ("Lao People's Democratic Republic", "Laos"),
        ("Viet Nam", "Vietnam"),
        ("  timor-LESTE ", "Timor-Leste"),
        (" Atlantis ", "Atlantis"),
        (None, None),
    ],
)
def test_country(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(text.canonical_country(F.col("c"))).first()[0] == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("38 000 ", 38000.0),
        ("1,130.90", 1130.90),
        ("<500 ", 500.0),
        ("", None),
        ("   ", None),
        ("n/a", None),
        ("12d", None),
        ("-1.5e2", -150.0),
        ("12 000", 12000.0),
        (None, None),
    ],
)
def test_number(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(text.number(F.col("v"))).first()[0] == expected


def test_headers():
    names = text.unique_headers(["Countries and areas", "2004M", "2004M", "2005F", "", "Unit "])
    assert names == ["countries_and_areas", "2004m", "2004m_1", "2005f", "unnamed_4", "unit"]
    assert [text.header_sex(n) for n in names] == [None, "Male", "Female", "Female", None, None]
    assert text.header_year("2004dpt") == 2004 and text.header_sex("2004dpt") is None
    assert text.header_year("x2004") is None


def test_indicator_of_file(spark):
    df = spark.createDataFrame([("goverment_expence_in_health.csv",), ("death_by_HIV_ AIDS.csv",)], "f string")
    found = [r[0] for r in df.select(text.indicator_of_file(F.col("f"))).collect()]
    assert found == ["government_expenditure_in_health", "death_by_hiv_aids"]
