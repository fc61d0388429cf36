import os

import pytest
from pyspark.sql import functions as F

from indicora.operators import series
from indicora.plans import etl, jobs
from indicora.sources import csv_folder, tables


def _load(spark, folder, **files):
    for name, content in files.items():
        data = content if isinstance(content, bytes) else content.encode()
        (folder / f"{name}.csv").write_bytes(data)
    return etl.load_folder(spark, str(folder))


def _rows(loaded, *columns, where="true"):
    found = loaded.table.where(where).select(*columns).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_wide(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        crude_birth="Countries and areas,Reference year(s),2004,2005\nBrunei Darussalam,2004-2005,19.9,18.7\n,,,\n",
    )
    assert _rows(got, "country", "year", "indicator", "value") == [
        ("Brunei", 2004, "crude_birth", 19.9), ("Brunei", 2005, "crude_birth", 18.7),
    ]


def test_year_suffix_and_sex(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        dpt="Countries and areas,2004DPT,2005DPT\nCambodia,91.7,99.7\n",
        life="Countries and areas,2004M,2004F\nBrunei Darussalam,74.6,77.5\n",
        twice="Countries and areas,2004M,2004M\nBrunei Darussalam,74.6,77.5\n",
    )
    assert _rows(got, "indicator", "year", "sex", "value") == sorted(
        [
            ("life", 2004, "Female", 77.5), ("life", 2004, "Male", 74.6),
            ("twice", 2004, "Female", 77.5), ("twice", 2004, "Male", 74.6),
            ("dpt", 2004, None, 91.7), ("dpt", 2005, None, 99.7),
        ],
        key=str,
    )


def test_sub_indicator_and_unit(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        spend="Countries,Indicators,Unit,2000\nBrunei Darussalam,Capital health expenditure,in million current US$,13.3\n",
    )
    assert _rows(got, "sub_indicator", "unit", "value") == [
        ("Capital health expenditure", "in million current US$", 13.3)
    ]


def test_long_with_probed_value_column(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        doctors="Country,Year,Physicians density (per 1000 population)\nBrunei Darussalam,2012,1.47\n",
        other="Country,Year,Label,Amount here\nLaos,2010,x,3\nAtlantis,2010,y,4\nLaos,1810,z,5\n",
    )
    assert _rows(got, "indicator", "country", "year", "value") == [
        ("doctors", "Brunei", 2012, 1.47), ("other", "Laos", 2010, 3.0)
    ]


def test_dirty_numbers_and_first_wins(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        hiv="Country,2016\nIndonesia,38 000 \nLao People's Democratic Republic,<500 \nIndonesia,7\n",
        **{"h i v": "Country,2016\nIndonesia,1\n", "hIV": "Country,2016\nIndonesia,2\n"},
    )
    rows = dict(_rows(got, "country", "value", where="indicator = 'hiv'"))
    # files are taken in name order, so hIV.csv is read before hiv.csv
    assert rows == {"Indonesia": 2.0, "Laos": 500.0}


def test_windows_charset(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        notes=b"Country,Indicators,2000\nLaos,child\x92s birth,5\n",
        latin=b"Country,Indicators,2000\nLaos,caf\xe9 \x81,5\n",
    )
    assert {r[0] for r in _rows(got, "sub_indicator")} == {"child’s birth", "café \u0081"}


def test_multi_line_cells(spark, tmp_path):
    got = _load(spark, tmp_path, m='Country,Indicators,2000\nLaos,"two\nlines, one cell",5\n')
    assert _rows(got, "sub_indicator", "value") == [("two\nlines, one cell", 5.0)]


def test_rejects_and_report(spark, tmp_path):
    got = _load(
        spark, tmp_path,
        good="Country,2000\nLaos,1\n",
        empty="",
        header="Country,2000\n",
        nocountry="Place,2000\nLaos,1\n",
        noyear="Country,Something\nLaos,1\n",
        novalue="Country,Year,Word\nLaos,2000,abc\n",
        two="Country,Year,A b,C d\nLaos,2000,1,2\n",
        foreign="Country,2000\nFrance,1\n",
        ragged="Country,2000\nLaos,1\nLaos,2,3\n",
        quoted='Country,Indicators,2000\nLaos,"a, b",3\n',
    )
    report = {r["file_name"]: r for r in etl.load_report(spark, got).collect()}
    assert report["good.csv"]["status"] == "processed" and report["good.csv"]["rows"] == 1
    assert {n for n, r in report.items() if r["status"] == "skipped"} == {
        f"{n}.csv" for n in ("empty", "header", "nocountry", "noyear", "novalue", "two", "foreign", "ragged")
    }
    assert "Multiple possible value columns" in report["two.csv"]["reason"]


def test_no_usable_file(spark, tmp_path):
    with pytest.raises(RuntimeError):
        _load(spark, tmp_path, bad="Place,2000\nLaos,1\n")


def test_one_plan_per_layout(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"f{i}.csv").write_text(f"Country,2000\nLaos,{i}\n")
    found = csv_folder.manifest(spark, str(tmp_path))
    assert len(found.layouts) == 1 and len(next(iter(found.layouts.values()))) == 6


def test_file_ledger(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country,2000\nLaos,1\n")
    (tmp_path / "b c.csv").write_text("Country,2000\nLaos,2\n")
    first = csv_folder.checksums(spark, str(tmp_path))
    ledger = spark.createDataFrame(first.collect(), first.schema)
    (tmp_path / "a.csv").write_text("Country,2000\nLaos,3\n")
    changed = etl.unseen_files(csv_folder.checksums(spark, str(tmp_path)), ledger)
    assert [r["file_name"] for r in changed.collect()] == ["a.csv"]


def test_metadata(spark):
    raw = spark.createDataFrame(
        [
            (1, "Prevalence of malaria and TB (percentage)", "d1", "u1", None),
            (2, "Crude birth ratio", "d2", "u2", None),
            (3, "Crude Birth Ratio", "later", "u3", None),
            (4, None, "x", "y", None),
        ],
        "row_number int, `Cleansed data` string, Description string, `Source link` string, `Unnamed: 4` string",
    )
    got = {r["indicator"]: r["description"] for r in etl.metadata_table(raw).collect()}
    assert got == {"malaria_prevalence": "d1", "tb_prevalence": "d1", "crude_birth_ratio": "d2"}
    with pytest.raises(ValueError):
        etl.metadata_table(raw.drop("Description"))


def test_replace_and_typed_read(spark, tmp_path):
    rows = spark.createDataFrame([(" Laos ", "2000", "x", "1.5"), ("Laos", "bad", "x", "2")], "country string, year string, indicator string, value string")
    typed = tables.typed_long_table(rows)
    assert [tuple(r) for r in typed.collect()] == [("Laos", 2000, "x", 1.5)]
    path = str(tmp_path / "t")
    tables.replace_table(typed, path)
    second = tables.replace_table(typed.union(typed), path)
    assert tables.current_version(spark, path) == second
    assert spark.read.parquet(second).count() == 2
    assert tables.read_metadata(spark, str(tmp_path / "none.csv")).count() == 0


@pytest.mark.skipif("RAW_INDICATOR_FOLDER" not in os.environ, reason="raw files not given")
def test_raw_goldens(spark):
    loaded = etl.load_folder(spark, os.environ["RAW_INDICATOR_FOLDER"])
    table = loaded.table.cache()
    assert table.count() == 1690
    assert table.select("country").distinct().count() == 10
    assert table.select("indicator").distinct().count() == 18
    assert series.annual_values(table).count() == 1593
    sums = dict(table.groupBy("indicator").agg(F.round(F.sum("value"), 3)).collect())
    assert sums["life_expentancy_rate"] == 13960.2 and sums["death_by_hiv_aids"] == 335100.0
    table.unpersist()


def test_batch_job(spark, tmp_path):
    folder, root = tmp_path / "raw", str(tmp_path / "lake")
    folder.mkdir()
    (folder / "tb_prevalence.csv").write_text("Country,2000,2001\nLaos,1,2\nViet Nam,3,\n")
    (folder / "broken.csv").write_text("Place,2000\nLaos,1\n")
    assert jobs.load_indicators(spark, str(folder), root) is not None
    assert jobs.load_indicators(spark, str(folder), root) is None
    (folder / "tb_prevalence.csv").write_text("Country,2000,2001\nLaos,1,2\nViet Nam,3,4\n")
    assert jobs.load_indicators(spark, str(folder), root) is not None
    table = jobs.current_long_table(spark, root)
    assert table.count() == 4 and table.where("indicator = 'tb_prevalence' AND value = 4").count() == 1
    runs = spark.read.parquet(f"{root}/pipeline_runs")
    assert runs.count() == 2 and {r["status"] for r in runs.collect()} == {"completed"}
    assert sorted(r["record_count_valid"] for r in runs.collect()) == [3, 4]
    assert all(r["record_count_in"] == r["record_count_valid"] + r["record_count_rejected"] for r in runs.collect())
    assert spark.read.parquet(f"{root}/metrics").count() == 6
    with pytest.raises(FileNotFoundError):
        jobs.current_long_table(spark, str(tmp_path / "none"))


def test_report_counts_nulls_like_the_validation(spark, tmp_path):
    got = _load(spark, tmp_path, a="Country,2000,2001\nLaos,1,2\n", b="Country,Unit,Indicators,2000M\nLaos,u,i,3\n")
    report = {r["file_name"]: r["rows_with_nulls"] for r in etl.load_report(spark, got).collect()}
    assert report == {"a.csv": 2, "b.csv": 0}
    found = {r["file_name"]: r["n"] for r in etl.load_warnings(got).where("rule = 'nulls'").collect()}
    assert found == {"a.csv": 2}
