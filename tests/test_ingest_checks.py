"""Folder ingest and text typing: every file's header, malformed rows, stored parameters,
numbers with type suffixes and timestamps with blanks."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from careflow.functions.parsing import parse_double, parse_int_rounding, parse_visit_ts
from careflow.operators.profile import column_types, value_counts
from careflow.params import MeasureParams
from careflow.plans.warehouse import build_warehouse, load_warehouse, materialize
from careflow.schema import RAW_HEADER
from careflow.sources.raw_csv import RawHeaderError, malformed_rows, read_raw_visits


def write_file(path, header, rows):
    path.write_text("\n".join([",".join(header), *(",".join(r) for r in rows)]) + "\n", encoding="utf-8")


def row(k):
    return [str(k), f"{k % 27 + 1:02d}-03-2024 08:47", "A", "B", "M", "40", "r", "None", "TRUE", "5", "33", "0"]


def test_swapped_columns_in_a_later_file_are_refused(spark, tmp_path):
    write_file(tmp_path / "a.csv", RAW_HEADER, [row(1)])
    assert read_raw_visits(spark, str(tmp_path)).count() == 1
    swapped = list(RAW_HEADER)
    swapped[5], swapped[10] = swapped[10], swapped[5]
    write_file(tmp_path / "b c.csv", swapped, [row(2)])
    with pytest.raises(RawHeaderError, match="b%20c.csv"):
        read_raw_visits(spark, str(tmp_path))


def test_rows_with_other_numbers_of_fields_are_counted(spark, tmp_path):
    write_file(tmp_path / "a.csv", RAW_HEADER, [row(1), row(2)[:9], [*row(3), "more"], row(4)])
    write_file(tmp_path / "b.csv", RAW_HEADER, [row(5)])
    found = malformed_rows(spark, str(tmp_path)).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["rows"]) for r in found] == [("a.csv", 2)]


def test_parameters_stay_with_the_warehouse(spark, edge_raw, tmp_path):
    params = MeasureParams(wait_target_minutes=20, run_length=6)
    materialize(build_warehouse(spark, edge_raw, params), str(tmp_path / "wh"))
    assert load_warehouse(spark, str(tmp_path / "wh")).params == params


def test_numbers_in_text(spark):
    texts = {"45F": None, "5d": None, "30D": None, "12f": None, " 7 ": 7.0, "12.6": 12.6, "-4.5": -4.5, "1e2": 100.0,
             ".5": 0.5, "": None, "0x1F": None, "1_000": None, "inf": math.inf, "--3": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse_double(F.col("t")).alias("d"), parse_int_rounding(F.col("t")).alias("i")).collect()
    assert {r["t"]: r["d"] for r in got} == texts
    assert {r["t"]: r["i"] for r in got}["12.6"] == 13 and {r["t"]: r["i"] for r in got}["inf"] is None


def test_timestamps_with_blanks(spark):
    df = spark.createDataFrame([("01-03-2024 08:47 ",), (" 1-3-2024 8:47",), ("x",)], "t string")
    got = [r[0] for r in df.select(parse_visit_ts(F.col("t"), strict=False)).collect()]
    assert got[0] == got[1] and got[0].isoformat() == "2024-03-01T08:47:00" and got[2] is None
    good = spark.createDataFrame([("01-03-2024 08:47 ",), (" 1-3-2024 8:47",)], "t string")
    assert good.select(parse_visit_ts(F.col("t"))).distinct().count() == 1


def test_profile_keeps_suffixed_numbers_as_text(spark):
    df = spark.createDataFrame([("10F", "1.5"), ("12D", "2"), ("13F", None)], "a string, b string")
    got = {r["column"]: r["dtype"] for r in column_types(value_counts(df)).collect()}
    assert got == {"a": "object", "b": "float64"}
