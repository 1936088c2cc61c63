"""Scalar functions, specs, history."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantmart.functions import dates, missing, text, units
from plantmart.session import cut_lineage, shared_folder, work_path
from plantmart.sources import files, history
from plantmart.sources.spec import Field, TableSpec, fields


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_dates(spark):
    def ts(s):
        return F.lit(s).cast("timestamp")

    assert one(spark, dates.production_day(ts("2024-01-02 05:59:59"), 6)) == dt.date(2024, 1, 1)
    assert one(spark, dates.production_day(ts("2024-01-02 06:00:00"), 6)) == dt.date(2024, 1, 2)
    assert [one(spark, dates.shift_code(ts(f"2024-01-02 {h}:00:00"))) for h in ("05", "06", "13", "14", "21", "22")] == ["ND", "OD", "OD", "MD", "MD", "ND"]
    assert one(spark, dates.cycle_position("2019-10-01", F.lit("2019-10-09").cast("date"), 14)) == -8
    assert one(spark, dates.cycle_position("2019-10-01", F.lit("2019-10-09").cast("date"), 14, signed=False)) == 6
    assert one(spark, dates.from_inverted(F.lit("79799468"))) == dt.date(2020, 5, 31)
    assert [one(spark, dates.month_number(F.lit(m))) for m in ("jan", "Dec", "x", None)] == [1, 12, 0, 0]
    assert one(spark, dates.parse_stamp(F.lit("2024-01-02 03:04:05.678"))) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, dates.parse_stamp(F.lit(""))) is None
    assert one(spark, dates.period_start(F.lit(2020), F.lit("004"))) == dt.date(2020, 4, 1)
    assert one(spark, dates.period_start(F.lit(2020), F.lit("016"))) is None
    assert one(spark, dates.trailing_year_start(F.lit("2020-02-29").cast("date"))) == dt.date(2019, 2, 1)
    assert one(spark, dates.months_since(F.lit("2020-07-20").cast("date"), F.lit("2020-01-04").cast("date"))) == 7.0


def test_calendar_week_around_new_year(spark):
    day = F.lit("2021-01-01").cast("date")
    assert one(spark, dates.calendar_columns(day)["calendar_week"]) == "2021 W53"
    assert one(spark, dates.calendar_columns(day, iso_year=True)["calendar_week"]) == "2020 W53"


def test_text(spark):
    assert one(spark, text.padded(F.lit(42), 10)) == "0000000042"
    assert one(spark, text.without_leading_zeros(F.lit("000420 "))) == "420"
    assert one(spark, text.without_leading_zeros(F.lit("0000"))) == ""
    assert one(spark, text.first_token(F.lit("ab_c,d e"), [" ", "_", ","])) == "ab"
    assert one(spark, text.first_token(F.lit("ALL OF IT"), [" "], keep="ALL OF IT")) == "ALL OF IT"
    assert one(spark, text.joined_key(F.lit("a"), F.lit(None).cast("string"))) is None


def test_missing(spark):
    assert [one(spark, missing.text_or_blank(F.lit(v).cast("string"))) for v in (None, "nan", "NULL", "", "x")] == ["", "", "", "", "x"]
    assert one(spark, missing.first_valid(F.lit(float("nan")), F.lit(2.0), numeric=True)) == 2.0
    with pytest.raises(ValueError, match="no such columns"):
        missing.fill(spark.range(1), {"nope": 0})


def test_units(spark):
    assert one(spark, units.to_kg(F.lit(1.0), F.lit("LB"))) == 0.45359237
    assert one(spark, units.to_lb(F.lit(0.45359237), F.lit("KG"))) == 1.0
    assert one(spark, units.signed_rate(F.lit(-4.0))) == 0.25
    assert one(spark, units.unit_factor(F.lit(1), F.lit(0), F.lit(2))) is None


SPEC = TableSpec(fields("Id:id:int", "Start Time:start:timestamp", Field("Note", "note", missing=("NULL",), default=""), Field("Extra", "extra", "double", optional=True)))


def test_spec_types_and_missing_columns(spark):
    raw = spark.createDataFrame([(" 7 ", "2024-01-01 00:00:01", "NULL"), ("x", "bad", None)], ["ID", "start time", "Note"])
    got = [tuple(r) for r in SPEC.apply(raw).collect()]
    assert got == [(7, dt.datetime(2024, 1, 1, 0, 0, 1), "", None), (None, None, "", None)]
    with pytest.raises(ValueError, match="lacks columns"):
        SPEC.apply(raw.drop("Note"))


def test_site_scan_checks_headers(spark, tmp_path):
    for site, lines in {"north west": "Id,Name\n1,a\n", "south": "Id,Name\n2,b\n", "a+b": "Id,Name\n3,c\n"}.items():
        (tmp_path / site).mkdir()
        (tmp_path / site / "x.csv").write_text(lines)
    spec = TableSpec(fields("Id:id:int", "Name"))
    got = files.scan_sites(spark, str(tmp_path), "x.csv", spec)
    assert sorted(map(tuple, got.collect())) == [("a+b", 3, "c"), ("north west", 1, "a"), ("south", 2, "b")]
    assert files.scan_optional_sites(spark, str(tmp_path), "sub/y.csv", spec).count() == 0
    (tmp_path / "south" / "x.csv").write_text("Name,Id\nb,2\n")
    with pytest.raises(Exception):
        files.scan_sites(spark, str(tmp_path), "x.csv", spec).collect()


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    df = cut_lineage(spark.range(5))
    assert df.count() == 5 and named in df.inputFiles()[0]


def test_upsert_is_idempotent_and_leaves_other_partitions(spark):
    path = work_path(spark, "history")
    schema = "site string, id int, day date, v string"
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([("A", 1, day, "x"), ("A", 2, day, "x"), ("B", 1, day, "x"), (None, 9, day, "x")], schema)
    history.upsert(spark, first, path, ["site", "id"], ["site", "day"])
    other = set(f for f in spark.read.parquet(path).inputFiles() if "site=B" in f)
    new = spark.createDataFrame([("A", 2, day, "y"), ("A", 3, day, "y"), (None, 9, day, "y")], schema)
    for _ in range(2):
        stored = history.upsert(spark, new, path, ["site", "id"], ["site", "day"])
        assert sorted((str(r.site), r.id, r.v) for r in stored.collect()) == [
            ("A", 1, "x"), ("A", 2, "y"), ("A", 3, "y"), ("B", 1, "x"), ("None", 9, "y"),
        ]
    assert set(f for f in spark.read.parquet(path).inputFiles() if "site=B" in f) == other
    with pytest.raises(ValueError, match="stored columns differ"):
        history.upsert(spark, new.withColumnRenamed("v", "w"), path, ["site", "id"], ["site", "day"])
