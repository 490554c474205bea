"""Steps whose time, memory or bytes once outgrew their input: what they do instead, and that the
results stay those of the plain way."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import DATA

from careflow.functions.parsing import CAST_TEXT, cast_double
from careflow.operators import marts, profile, spc, wait_counts
from careflow.plans import round_trip
from careflow.plans.warehouse import build_warehouse
from careflow.sources.raw_csv import read_raw_visits
from careflow.streaming.refresh import DatedTables, refresh_batch

TEXTS = ["1", " 7 ", "-1.5e3", "45F", "2d", "0x1.8p1", "0x1p", ".5", "5.", ".", "e3", "1e", "+inf", "-Infinity", "NaN",
         "infinit", "1-2-2024", "X", "", " ", "\t3\n", "12 4", "1.2.3", "00012", "1e400", " 5", "５", "--1", None]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cast_double_is_the_cast(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    rows = df.select("v", cast_double(F.col("v")).alias("a"), F.col("v").try_cast("double").alias("b")).collect()
    assert all(r.a == r.b or (r.a != r.a and r.b != r.b) for r in rows)
    assert not any(re.match(r"^\s*[0-9]{1,4}[-/.][0-9]{1,2}[-/.]", r.v or "") for r in rows if r.b is not None)
    assert df.where(F.col("v").rlike(CAST_TEXT) & F.col("v").try_cast("double").isNull()).count() <= 1


def test_a_text_is_read_once_for_the_profile(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    vc = profile.counted_values(df)
    assert {"x", "is_int", "is_number", "is_dated"} <= set(vc.columns)
    assert "RLIKE" not in plan(profile.column_types(vc)) and "Scan parquet" in plan(vc)


def test_object_texts_are_not_shuffled_again(spark):
    df = spark.createDataFrame([(f"id-{i % 7}", str(i % 3)) for i in range(50)], "a string, b string")
    got = {(r["column"], r.value): r.n for r in profile.typed_value_counts(profile.counted_values(df)).collect()}
    assert got[("a", "id-0")] == 8 and got[("b", "0")] == 17 and len(got) == 10


@pytest.mark.parametrize("copies", [0, 3])
def test_overview_looks_marks_up_by_join(spark, copies):
    rows = [(str(i), None) for i in range(20)] + [("x", "y")] * copies + [(None, None)] * copies
    df = spark.createDataFrame(rows, "a string, b string")
    out = profile.overview(df)
    assert "bits" not in plan(out)
    assert out.first().asDict() == {"rows": len(rows), "columns": 2, "fully_duplicated_rows": 2 * max(copies - 1, 0)}


def test_daily_rows_do_not_build_the_cells(spark):
    raw = read_raw_visits(spark, str(DATA / "edge_visits.csv"))
    wh = build_warehouse(spark, raw, strict_dates=False)
    daily, hourly = wh.agg_daily_ops.collect(), wh.agg_hourly_arrivals.collect()
    assert callable(wh._tables["agg_visit_cells"])
    cells = wait_counts.visit_cells(wh.fct_er_visit)
    key = lambda r: str(tuple(r))
    assert sorted(daily, key=key) == sorted(spc.agg_daily_ops(cells).collect(), key=key)
    assert sorted(hourly, key=key) == sorted(marts.agg_hourly_arrivals(cells).collect(), key=key)


def test_a_batch_leaves_the_rows_of_earlier_batches(spark, tmp_path):
    raw = read_raw_visits(spark, str(DATA / "edge_visits.csv"))
    tables = DatedTables(spark, str(tmp_path / "wh"), grain="year")
    refresh_batch(tables, raw, 0)
    before = {p: p.stat().st_mtime_ns for t in ("fct_er_visit", "agg_visit_cells", "segment_members")
              for p in (tmp_path / "wh" / t).rglob("part-*")}
    refresh_batch(tables, raw, 1)
    assert before and all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items())
    assert tables.read("fct_er_visit").count() == 2 * raw.count()


def test_crowded_partitions_are_written_by_several_tasks(spark, tmp_path):
    """Grain of a year: the cells of one year come from all tasks of their aggregation."""
    raw = spark.range(4000, numPartitions=4).select(
        F.concat(F.lit("V"), "id").alias("patient_id"),
        F.concat(F.format_string("%02d", 1 + F.col("id") % 28), F.lit("-03-2024 10:00")).alias("admission_date_raw"),
        *[F.lit("X").alias(c) for c in ("first_initial", "last_name", "gender_raw")], F.lit("30").alias("age_raw"),
        F.lit("White").alias("race_raw"), F.lit("None").alias("department_referral_raw"),
        F.lit("TRUE").alias("admitted_flag_raw"), F.lit("5").alias("satisfaction_score_raw"),
        (F.col("id") % 50).cast("string").alias("wait_minutes_raw"), F.lit("0").alias("case_management_flag_raw"))
    tables = DatedTables(spark, str(tmp_path / "wh"), grain="year")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        refresh_batch(tables, raw, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "wh" / "agg_visit_cells").rglob("part-*.parquet"))) > 1


def test_landed_and_exported_files_are_compressed(spark, tmp_path):
    raw = read_raw_visits(spark, str(DATA / "edge_visits.csv"))
    path = round_trip.write_raw_csv(raw, str(tmp_path / "raw"))
    assert all(p.suffix == ".gz" for p in (tmp_path / "raw").glob("part-*"))
    key = lambda r: str(tuple(r))
    assert sorted(read_raw_visits(spark, path).collect(), key=key) == sorted(raw.collect(), key=key)
