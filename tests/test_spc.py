"""XmR and p-chart rules against a brute-force evaluator written from the definition."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from careflow.operators.spc import p_chart, xmr_chart
from careflow.params import DEFAULT_PARAMS as P


def brute_xmr(values):
    """Signals per day for a list of daily values (None = no plausible wait)."""
    obs = [v for v in values if v is not None]
    centre = sum(obs) / len(obs) if obs else None
    mrs = [abs(b - a) for a, b in zip(values, values[1:]) if a is not None and b is not None]
    sigma = (sum(mrs) / len(mrs)) / P.mr_d2 if mrs else None
    out = []
    sides, b2 = [], []
    for v in values:
        if v is None or centre is None:
            sides.append(0)
        else:
            sides.append(1 if v > centre else -1 if v < centre else 0)
        if v is None or centre is None or sigma is None:
            b2.append(0)
        else:
            b2.append(1 if v > centre + 2 * sigma else -1 if v < centre - 2 * sigma else 0)
    for i, v in enumerate(values):
        run = 1
        while i - run >= 0 and sides[i - run] == sides[i]:
            run += 1
        window = b2[max(0, i - 2): i + 1]
        ucl = lcl = None
        if centre is not None and sigma is not None:
            ucl, lcl = centre + P.spc_sigma * sigma, max(centre - P.spc_sigma * sigma, 0.0)
        if v is not None and ucl is not None and (v > ucl or v < lcl):
            out.append("point_beyond_limit")
        elif sides[i] != 0 and run >= P.run_length:
            out.append("run_of_8")
        elif window.count(1) >= 2 or window.count(-1) >= 2:
            out.append("two_of_three_beyond_2sigma")
        else:
            out.append(None)
    return out


def _series(spark, values):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "visit_date date, median_wait_minutes double")


def _signals(spark, values):
    out = xmr_chart(_series(spark, values)).orderBy("visit_date").collect()
    return [r["spc_signal"] for r in out]


def test_run_of_8_fires_from_eighth_day(spark):
    vals = [25, 35] * 4 + [30] + [32] * 9 + [28] * 9   # centre line exactly 30
    sig = _signals(spark, vals)
    assert sig == brute_xmr(vals)
    assert sig[9 + 6] is None and sig[9 + 7] == "run_of_8" and sig[9 + 8] == "run_of_8"
    assert sig[18 + 6] is None and sig[18 + 7] == "run_of_8"


def test_two_of_three_quirk_and_null_day(spark):
    vals = [30, 31, 29, 30, 31, 29, 30, 60, 58, 30, 31, 29, None, 30, 31, 29, 30]
    sig = _signals(spark, vals)
    assert sig == brute_xmr(vals)
    assert "two_of_three_beyond_2sigma" in sig


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_series_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    vals = [None if rnd.random() < 0.05 else round(rnd.gauss(35, 6) + (8 if 40 < i < 60 else 0), 1)
            for i in range(120)]
    assert _signals(spark, vals) == brute_xmr(vals)


def test_limits_order(spark):
    vals = [30 + (i % 7) for i in range(50)]
    r = xmr_chart(_series(spark, vals)).agg(
        F.bool_and((F.col("wait_lcl") <= F.col("wait_centre_line"))
                   & (F.col("wait_centre_line") <= F.col("wait_ucl")))
    ).first()[0]
    assert r is True


def test_series_keys_are_independent(spark):
    a, b = [30] * 3 + [31] * 9, [40, 10, 40, 10, 40, 10, 40, 10, 40, 10, 40, 10]
    df = _series(spark, a).withColumn("dept", F.lit("a")).unionByName(
        _series(spark, b).withColumn("dept", F.lit("b")))
    out = xmr_chart(df, series_keys=["dept"]).orderBy("dept", "visit_date").collect()
    assert [r["spc_signal"] for r in out if r["dept"] == "a"] == brute_xmr(a)
    assert [r["spc_signal"] for r in out if r["dept"] == "b"] == brute_xmr(b)


def test_p_chart(spark):
    rows = [(dt.date(2024, 1, d), v, a) for d, (v, a) in enumerate([(10, 5), (100, 50), (2, 2), (50, 5)], 1)]
    df = spark.createDataFrame(rows, "visit_date date, visits long, admissions long")
    out = {r["visit_date"].day: r for r in p_chart(df).collect()}
    p = 62 / 162
    for d, (v, a) in enumerate([(10, 5), (100, 50), (2, 2), (50, 5)], 1):
        s = math.sqrt(p * (1 - p) / v)
        assert out[d]["admit_centre_line"] == pytest.approx(p)
        assert out[d]["admit_ucl"] == pytest.approx(min(p + 3 * s, 1.0))
        assert out[d]["admit_lcl"] == pytest.approx(max(p - 3 * s, 0.0))
        assert out[d]["admit_limits_clipped"] == ((p + 3 * s > 1) or (p - 3 * s < 0))
    assert out[4]["admit_signal"] == "point_beyond_limit"
    assert out[2]["admit_signal"] is None


def _dated(spark, dates, values):
    rows = [(d, None if v is None else float(v)) for d, v in zip(dates, values)]
    return spark.createDataFrame(rows, "visit_date date, median_wait_minutes double")


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_series_across_years_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    dates, d = [], dt.date(2015, 12, 20)
    for _ in range(150):
        d = d + dt.timedelta(days=rnd.choice([1, 1, 2, 30, 200, 400]))  # sparse years, 1-row years
        dates.append(d)
    # long runs on one side that cross year boundaries, plus noise and missing medians
    vals = []
    for i in range(150):
        base = 40 if (i // 25) % 2 == 0 else 30
        vals.append(None if rnd.random() < 0.04 else round(base + rnd.gauss(0, 2), 1))
    out = xmr_chart(_dated(spark, dates, vals)).orderBy("visit_date").collect()
    assert [r["spc_signal"] for r in out] == brute_xmr(vals)
    assert len({d.year for d in dates}) > 5


def test_run_crossing_new_year(spark):
    dates = [dt.date(2023, 12, 20) + dt.timedelta(days=i) for i in range(30)]
    vals = [25, 35] * 4 + [30] + [32] * 12 + [28] * 9   # the run of 32s spans 2023 -> 2024
    out = xmr_chart(_dated(spark, dates, vals)).orderBy("visit_date").collect()
    sig = [r["spc_signal"] for r in out]
    assert sig == brute_xmr(vals)
    assert sig[9 + 7] == "run_of_8" and dates[9 + 7].year == 2024 and dates[9].year == 2023


def test_null_series_key_and_null_date_keep_rows(spark):
    a = [30] * 3 + [31] * 9
    df = _series(spark, a).withColumn("dept", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([(None, 33.0, None)], "visit_date date, median_wait_minutes double, dept string"))
    out = xmr_chart(df, series_keys=["dept"]).collect()
    assert len(out) == 13
