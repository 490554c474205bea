"""Layout votes, sketches and row digests of the profile on small and on adverse tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from careflow.operators import layouts, profile, sketches


def column(spark, name, values):
    return spark.createDataFrame([(name, v, n) for v, n in values], "column string, value string, n long")


def test_votes_decide_the_order_and_habits_break_ties(spark):
    vc = (column(spark, "us", [("3/14/2024", 2), ("3/4/2024", 9)])
          .unionByName(column(spark, "eu", [("14/3/2024 7:05", 1), ("3/4/2024 23:59:59", 9)]))
          .unionByName(column(spark, "tie", [("03-04-2024", 1), ("3/4/2024", 1), ("3.4.2024", 1), ("2024-04-03", 1)]))
          .unionByName(column(spark, "both", [("13-01-2024", 1), ("01-13-2024", 3), (" 2024.25.12 ", 2)]))
          .unionByName(column(spark, "none", [("31-02-2024", 5), ("3-4/2024", 1), ("2024-13-13", 1), ("1-2-24", 1),
                                              ("1-2-2024 24:00", 1), ("text", 1), ("", 1), (None, 4), ("1234-5-6789", 1)])))
    votes = {(r["column"], r["sep"], r["year_first"]): (r.day_first_votes, r.month_first_votes, r.day_first)
             for r in layouts.layout_votes(vc).collect()}
    assert votes == {
        ("us", "/", False): (9, 11, False), ("eu", "/", False): (10, 9, True),
        ("tie", "-", False): (1, 1, True), ("tie", "/", False): (1, 1, False), ("tie", ".", False): (1, 1, True),
        ("tie", "-", True): (1, 1, False), ("both", "-", False): (1, 3, False), ("both", ".", True): (2, 0, True)}
    read = {(r["column"], r["value"]): r["ts"] for r in layouts.parsed(vc).collect()}
    assert len(read) == vc.count()
    assert read["us", "3/4/2024"] == dt.datetime(2024, 3, 4) and read["eu", "3/4/2024 23:59:59"] == dt.datetime(2024, 4, 3, 23, 59, 59)
    assert read["tie", "3/4/2024"] == dt.datetime(2024, 3, 4) and read["tie", "3.4.2024"] == dt.datetime(2024, 4, 3)
    assert read["both", "13-01-2024"] is None  # the column's order is the other one
    assert read["both", " 2024.25.12 "] == dt.datetime(2024, 12, 25)
    assert all(ts is None for (c, _), ts in read.items() if c == "none")


def test_parts_of_seconds(spark):
    vc = column(spark, "t", [("2024-02-29T01:02:03.5", 1), ("2023-02-29T01:02:03", 1)])
    read = {r["value"]: r["ts"] for r in layouts.parsed(vc).collect()}
    assert read["2024-02-29T01:02:03.5"] == dt.datetime(2024, 2, 29, 1, 2, 3, 500_000)
    assert read["2023-02-29T01:02:03"] is None


ROWS = [("a", None), (None, "a"), ("a", ""), ("a", None), ("", "a"), ("a", None), (None, None), (None, None), ("b", "c")]


@pytest.mark.parametrize("case", ["plain", "full filter", "all digests meet"])
def test_duplicated_rows_are_exact_whatever_the_digests_do(spark, monkeypatch, case):
    if case == "full filter":
        monkeypatch.setattr(profile, "DIGEST_WORDS", 1)
    if case == "all digests meet":
        monkeypatch.setattr(profile, "_row_digest", lambda df: df.select(
            "*", F.lit(5).cast("long").alias("_d1"), F.lit(-1).cast("long").alias("_d2")))
    df = spark.createDataFrame(ROWS, "`x y` string, z string")
    r = profile.overview(df).first()
    assert (r["rows"], r["columns"], r["fully_duplicated_rows"]) == (9, 2, 3)


def test_overview_of_an_empty_table(spark):
    r = profile.overview(spark.createDataFrame([], "a string")).first()
    assert tuple(r) == (0, 1, 0)


def test_sketches_merge_and_keep_their_bounds(spark, tmp_path):
    df = spark.range(40_000).select(
        (F.col("id") % 7).cast("string").alias("few"), F.col("id").cast("string").alias("all"),
        F.when(F.col("id") % 3 == 0, F.pow(F.col("id") % 1000, 2).cast("string")).alias("some"),
        F.lit(None).cast("string").alias("none"), F.concat(F.lit("t"), F.col("id") % 500).alias("text"))
    parts = sketches.column_sketches(df, F.col("all").cast("int") % 4)
    parts.write.parquet(str(tmp_path / "sketches"))
    parts = spark.read.parquet(str(tmp_path / "sketches"))
    assert parts.count() == 4 * 5
    got = {r["column"]: r for r in sketches.estimates(sketches.merged_sketches(parts)).collect()}
    exact = {"few": 7, "all": 40_000, "some": 1000, "none": 0, "text": 500}
    for name, n in exact.items():
        low, high = n * (1 - sketches.DISTINCT_ERROR) - 1, n * (1 + sketches.DISTINCT_ERROR) + 1
        assert low <= got[name]["distinct"] <= high, name
        assert got[name]["rows"] == 40_000
    assert got["none"]["nulls"] == 40_000 and got["none"]["p50"] is None and got["text"]["p50"] is None
    for name, p in sketches.PROBS.items():
        assert abs(got["all"][name] / 40_000 - p) <= sketches.RANK_ERROR + 1e-3
    one = sketches.estimates(sketches.merged_sketches(parts, ["source", "column"])).where("column = 'all' AND source = 1")
    assert abs(one.first()["distinct"] - 10_000) <= 10_000 * sketches.DISTINCT_ERROR
