"""The profile against pandas on the hand-written raw file."""

from __future__ import annotations

import pandas as pd
import pytest

from careflow.operators import profile
from careflow.sources.raw_csv import read_csv_for_profile

from conftest import DATA

CSV = str(DATA / "edge_visits.csv")


@pytest.fixture(scope="module")
def raw(spark):
    return read_csv_for_profile(spark, CSV)


@pytest.fixture(scope="module")
def pdf():
    return pd.read_csv(CSV)


def test_columns_match_pandas(raw, pdf):
    got = {r["column"]: r for r in profile.column_summary(raw).collect()}
    assert list(got) and len(got) == len(pdf.columns)
    for c in pdf.columns:
        assert got[c]["nulls"] == int(pdf[c].isna().sum()), c
        assert got[c]["distinct"] == int(pdf[c].nunique(dropna=True)), c
        assert got[c]["null_pct"] == pytest.approx(round(pdf[c].isna().mean() * 100, 1)), c
        assert got[c]["dtype"] == str(pdf[c].dtype), c
    assert got["Patient Id"]["duplicate_values"] == int(pdf["Patient Id"].duplicated().sum())


def test_overview_and_duplicates(raw, pdf):
    r = profile.overview(raw).first()
    assert (r["rows"], r["columns"], r["fully_duplicated_rows"]) == (len(pdf), len(pdf.columns),
                                                                      int(pdf.duplicated().sum()))


def test_value_counts_match_pandas(raw, pdf):
    vc = profile.low_cardinality_values(raw).collect()
    cols = {r["column"] for r in vc}
    expect_cols = {c for c in pdf.columns if 0 < pdf[c].nunique(dropna=True) <= 15}
    assert cols == expect_cols
    for c in expect_cols:
        ours = {r["value"]: r["n"] for r in vc if r["column"] == c}
        theirs = pdf[c].astype(object).where(pdf[c].notna(), None).value_counts(dropna=False)
        assert sum(ours.values()) == int(theirs.sum())
        assert sorted(ours.values(), reverse=True) == sorted(theirs.tolist(), reverse=True)[:15]


def test_numeric_describe_matches_pandas(raw, pdf):
    got = {r["column"]: r for r in profile.numeric_describe(raw, exact=True).collect()}
    d = pdf.select_dtypes("number").describe(percentiles=[0.25, 0.5, 0.75, 0.9, 0.95, 0.99])
    assert set(got) == set(d.columns)
    for c in d.columns:
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("p90", "90%"),
                             ("p95", "95%"), ("p99", "99%"), ("max", "max")]:
            assert got[c][ours] == pytest.approx(d.loc[theirs, c]), (c, ours)


def test_datetime_columns(raw):
    got = {r["column"]: r for r in profile.datetime_columns(raw).collect()}
    assert set(got) == {"Patient Admission Date"}
    assert str(got["Patient Admission Date"]["min"]) == "2024-03-01 08:47:00"
