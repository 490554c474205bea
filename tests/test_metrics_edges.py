"""Metric semantics on the hand-written edge file and properties on driver data."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from careflow.operators import measures, metrics
from careflow.plans.catalog import warehouse

from conftest import SF001, SF0001


def test_calendar_is_gap_free_and_daily_is_observed_only(edge_wh):
    days = [r["date_day"] for r in edge_wh.dim_date.orderBy("date_day").collect()]
    assert days == [dt.date(2024, 3, d) for d in range(1, 6)]
    assert edge_wh.agg_daily_ops.count() == 4  # 2024-03-03 has no visits
    cov = metrics.date_coverage_check(edge_wh).first()
    assert (cov["span_days"], cov["distinct_days"], cov["gap_free"]) == (5, 4, False)


def test_day_of_week_and_weekend(edge_wh):
    r = {x["date_day"]: x for x in edge_wh.dim_date.collect()}
    assert r[dt.date(2024, 3, 3)]["day_of_week_num"] == 0 and r[dt.date(2024, 3, 3)]["is_weekend"]
    assert r[dt.date(2024, 3, 2)]["day_name"] == "Saturday" and r[dt.date(2024, 3, 2)]["is_weekend"]
    assert r[dt.date(2024, 3, 1)]["month_name"] == "March" and not r[dt.date(2024, 3, 1)]["is_weekend"]


def test_empty_hours_are_not_peak(edge_wh):
    t = {x["hour_of_day"]: x for x in edge_wh.dim_time_of_day.collect()}
    assert len(t) == 24 and not any(t[h]["is_peak"] for h in (2, 3, 4, 5))
    assert (t[7]["shift"], t[14]["shift"], t[15]["shift"], t[22]["shift"], t[23]["shift"]) == \
        ("Day", "Day", "Evening", "Evening", "Night")
    by_hour = {x["hour_of_day"]: x["arrivals"] for x in metrics.demand_by_hour(edge_wh).collect()}
    assert by_hour[3] == 0 and by_hour[1] == 2


def test_null_median_day(edge_wh):
    d = {x["visit_date"]: x for x in edge_wh.agg_daily_ops.collect()}
    assert d[dt.date(2024, 3, 4)]["median_wait_minutes"] is None
    assert d[dt.date(2024, 3, 4)]["spc_signal"] is None


def test_invalid_values_and_histogram(edge_wh):
    r = metrics.invalid_value_check(edge_wh).first()
    assert (r["implausible_waits"], r["negative_waits"], r["out_of_range_satisfaction"],
            r["null_admitted_flag"]) == (1, 1, 1, 1)
    hist = {x["bucket_start"]: x["n"] for x in metrics.wait_histogram(edge_wh).collect()}
    n_plausible = metrics.wait_summary_stats(edge_wh).first()["n_plausible"]
    assert sum(hist.values()) == n_plausible == 9
    assert hist[-5] == 1 and hist[30] == 2 and hist[240] == 1


def test_weekend_average_null_without_weekend(spark, edge_wh):
    from careflow.plans.warehouse import build_warehouse

    weekday_only = edge_wh.raw_visits.filter(F.col("admission_date_raw").startswith("0"))
    weekday_only = weekday_only.filter(~F.col("admission_date_raw").startswith("02-03"))
    r = metrics.demand_volume_stats(build_warehouse(spark, weekday_only)).first()
    assert r["weekend_avg"] is None and r["weekend_uplift"] is None and r["weekday_avg"] is not None


def test_constant_indicator_correlation_is_null(spark, edge_wh):
    from careflow.plans.warehouse import build_warehouse

    nobody = edge_wh.raw_visits.withColumn("satisfaction_score_raw", F.lit(None).cast("string"))
    r = metrics.satisfaction_nonresponse_bias(build_warehouse(spark, nobody)).first()
    assert r["corr_wait_responded"] is None and r["corr_admitted_responded"] is None
    everybody = edge_wh.raw_visits.withColumn("satisfaction_score_raw", F.lit("7"))
    r = metrics.satisfaction_nonresponse_bias(build_warehouse(spark, everybody)).first()
    assert r["corr_wait_responded"] is None and r["corr_admitted_responded"] is None
    o = metrics.satisfaction_overview(build_warehouse(spark, everybody)).first()
    assert o["response_rate"] == 1.0 and o["sd_score"] == 0.0


def test_equity_dimension_guard(edge_wh):
    with pytest.raises(ValueError):
        metrics.segment_equity_by(edge_wh, "last_name")


def test_suppression_iff_small_cell(spark):
    wh = warehouse(spark, SF0001)
    rows = wh.agg_segment_waits.collect()
    assert any(r["low_n_flag"] for r in rows)
    for r in rows:
        assert r["low_n_flag"] == (r["n_plausible"] < 30)
        assert (r["median_wait_minutes"] is None) == r["low_n_flag"]
        if not r["low_n_flag"]:
            assert r["ci_lower"] <= r["median_wait_minutes"] <= r["ci_upper"]


def test_spc_signals_present_at_sf001(spark):
    d = warehouse(spark, SF001).agg_daily_ops
    counts = {r["spc_signal"]: r["n"] for r in d.groupBy("spc_signal").agg(F.count("*").alias("n")).collect()}
    assert counts.get("point_beyond_limit", 0) == 5
    assert counts.get("run_of_8", 0) == 23
    assert counts.get("two_of_three_beyond_2sigma", 0) == 5
    assert d.filter(F.col("admit_signal").isNotNull()).count() == 3
    assert d.filter("admit_limits_clipped").count() == 1


def test_quintiles_sizes(spark):
    q = metrics.load_vs_wait_quintiles(warehouse(spark, SF001)).collect()
    sizes = [r["n_hours"] for r in q]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_monthly_measures_prior_month(spark):
    wh = warehouse(spark, SF0001)
    m = measures.monthly_measures(wh).orderBy("month_start").collect()
    assert m[0]["visits_pm"] is None          # no earlier month in the calendar
    assert m[1]["visits_pm"] == m[0]["visits"]  # a whole month maps to the whole previous one
    # the last calendar month is partial: it is compared with the same days one month back
    last, prev = m[-1], m[-2]
    hi = wh.dim_date.agg(F.max("date_day")).first()[0]
    lo_prev = hi.replace(day=1).replace(month=hi.month - 1) if hi.month > 1 else hi.replace(
        year=hi.year - 1, month=12, day=1)
    same_days = wh.fct_er_visit.filter(
        (F.col("visit_date") >= F.lit(lo_prev)) & (F.col("visit_date") <= F.lit(hi.replace(
            month=lo_prev.month, year=lo_prev.year)))).count()
    assert last["visits_pm"] == (same_days or None)
    assert last["visits_pm"] is None or last["visits_pm"] <= prev["visits"]


def test_heatmap_matrix_shape(spark):
    rows = metrics.demand_heatmap_matrix(warehouse(spark, SF0001)).collect()
    assert len(rows) == 7 and len(rows[0]) == 26


def test_age_band_order_shows_missing_bands(edge_wh):
    rows = metrics.segment_equity_by_age_band_ordered(edge_wh).collect()
    assert [r["segment_value"] for r in rows] == ["0-17", "18-34", "35-49", "50-64", "65+"]
    assert rows[4]["n"] == 0 and rows[4]["median_wait"] is None  # 65+ has no plausible wait


def test_source_quirk_switches(spark, edge_wh):
    from careflow.operators import dims

    t = {x["hour_of_day"]: x["is_peak"]
         for x in dims.dim_time_of_day(spark, edge_wh.stg_er_visits, empty_hours_peak=True).collect()}
    assert all(t[h] for h in (2, 3, 4, 5))
    hist = {x["bucket_start"]: x["n"] for x in metrics.wait_histogram(edge_wh, source_bins=True).collect()}
    assert hist[31.0] == 1 and hist[13.0] == 1 and sum(hist.values()) == 9


def test_source_shaped_bundles(edge_wh):
    split = metrics.segment_equity_extremes_split(edge_wh, 3)
    assert set(split) == {"top", "bottom"} and "extreme" not in split["top"].columns
    rep = metrics.satisfaction_nonresponse_report(edge_wh)
    assert rep["by_response_group"].count() == 2


def test_lenient_dates_kpi(spark, edge_wh):
    from careflow.plans.warehouse import build_warehouse

    bad = edge_wh.raw_visits.withColumn(
        "admission_date_raw",
        F.when(F.col("patient_id") == "P01", F.lit("not a date")).otherwise(F.col("admission_date_raw")))
    wh = build_warehouse(spark, bad, strict_dates=False)
    k = metrics.kpi_summary(wh).first()
    assert k["visits"] == 14 and k["n_days"] == 4 and k["total_days"] == 5
    s = {r["check_id"]: r["failures"] for r in __import__("careflow.operators.quality", fromlist=["x"])
         .run_checks(wh).collect()}
    assert s["fct_visit_date_not_null"] == 1 and s["stg_visit_date_not_null"] == 1


def test_suppression_edge_29_and_30(spark):
    from careflow.plans.warehouse import build_warehouse
    from careflow.schema import RAW_COLUMNS

    rows = []
    for i in range(29):   # segment A: 29 plausible waits (+1 implausible, which does not count)
        rows.append((f"A{i}", "01-03-2024 08:00", "A", "B", "F", "20", "Asian", "None", "TRUE", None, str(20 + i), "0"))
    rows.append(("A99", "01-03-2024 08:00", "A", "B", "F", "20", "Asian", "None", "TRUE", None, "500", "0"))
    for i in range(30):   # segment B: exactly 30 plausible waits
        rows.append((f"B{i}", "01-03-2024 09:00", "A", "B", "M", "70", "White", "None", "FALSE", None, str(10 + i), "0"))
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    seg = {r["gender"]: r for r in build_warehouse(spark, raw).agg_segment_waits.collect()}
    assert (seg["F"]["n_visits"], seg["F"]["n_plausible"], seg["F"]["low_n_flag"]) == (30, 29, True)
    assert seg["F"]["median_wait_minutes"] is None and seg["F"]["ci_lower"] is None
    assert (seg["M"]["n_plausible"], seg["M"]["low_n_flag"]) == (30, False)
    assert seg["M"]["median_wait_minutes"] == 24.5


def test_measures_contexts_add_up(spark):
    wh = warehouse(spark, SF0001)
    total = measures.measures(wh, ()).first()
    for by in (("year",), ("day_of_week_num", "is_weekend"), ("month_start",)):
        rows = measures.measures(wh, by).collect()
        assert sum(r["visits"] for r in rows) == total["visits"], by
        assert sum(r["admissions"] for r in rows) == total["admissions"], by
        assert sum(r["out_of_control_days"] for r in rows) == total["out_of_control_days"], by
    assert total["peak_hour_arrivals"] >= total["arrivals_per_hour"]
