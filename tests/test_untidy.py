"""Visits with missing dates, dimension contexts of the measures, and files of lone NULLs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001

from careflow.operators.measures import dimension_measures, measures
from careflow.operators.spc import xmr_chart
from careflow.plans import catalog
from careflow.sources.sinks import export_csv


@pytest.fixture(scope="module")
def wh(spark):
    return catalog.warehouse(spark, SF0001, "orders")


def test_rows_without_a_date_come_last_in_the_chart(spark):
    days = [(dt.date(2021, 12, 30), 1.0), (dt.date(2021, 12, 31), 5.0), (dt.date(2022, 1, 1), 2.0), (None, 90.0)]
    rows = xmr_chart(spark.createDataFrame(days, "visit_date date, median_wait_minutes double")).collect()
    centre = 98.0 / 4
    sigma = ((4 + 3 + 88) / 3) / 1.128  # the moving range of the last row is to 1 January
    assert len(rows) == 4
    for row in rows:
        assert row.wait_centre_line == pytest.approx(centre)
        assert row.wait_ucl == pytest.approx(centre + 3 * sigma)


@pytest.mark.parametrize("by", [("hour_of_day",), ("race", "age_band"), ("year", "department_referral"),
                                ("is_peak", "day_of_week_num"), ("gender", "shift", "month")])
def test_measures_of_any_mixture_count_every_visit(wh, by):
    got = measures(wh, by)
    visits = wh.fct_er_visit.count()
    total = got.agg(F.sum("visits")).first()[0]
    assert total == visits
    assert got.count() == got.select(*by).distinct().count()


def test_daily_measures_stay_with_calendar_contexts(wh):
    assert "wait_ucl" in measures(wh, ("year",)).columns
    assert "wait_ucl" not in measures(wh, ("gender",)).columns
    assert "arrivals_per_hour" in measures(wh, ("shift",)).columns
    with pytest.raises(ValueError):
        dimension_measures(wh, ("colour",))


def test_a_lone_null_survives_the_export(spark, tmp_path):
    df = spark.createDataFrame([("A",), (None,)], "department_referral string")
    files = export_csv({"dim_department": df}, str(tmp_path), keep_lone_nulls=True)
    assert spark.read.option("header", True).csv(files["dim_department"]).count() == 2
