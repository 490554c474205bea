"""Counted waits, contexts in one pass and prior months under other dimensions."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001

from careflow.operators import measures, metrics, spc
from careflow.operators import wait_counts as wc
from careflow.plans import catalog
from careflow.plans.warehouse import Warehouse, build_warehouse, load_warehouse, materialize

PROBS = {"median": 0.5, "p90": 0.9}


@pytest.fixture(scope="module")
def wh(spark):
    return catalog.warehouse(spark, SF0001, "orders")


@pytest.fixture(scope="module")
def written(spark, wh, tmp_path_factory):
    return materialize(wh, str(tmp_path_factory.mktemp("wh")))


def test_states_of_parts_merge_to_the_state_of_the_whole(wh):
    fct = wh.fct_er_visit
    third = F.pmod(F.xxhash64("visit_id", "visit_ts"), F.lit(3))
    parts = [wc.visit_cells(fct.where(third == n)) for n in range(3)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for keys in ([], ["segment_key"], ["visit_date", "department_referral"]):
        whole, split = (wc.quantiles(wc.merged(x, keys), keys, PROBS) for x in (wc.visit_cells(fct), union))
        assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, split.collect()), key=repr)


def test_quantiles_and_moments_equal_numpy(wh):
    waits = {}
    for r in wh.fct_er_visit.where("not wait_implausible_flag").select("segment_key", "wait_minutes").collect():
        waits.setdefault(r[0], []).append(r[1])
    rows = wc.as_cells(wh.agg_visit_cells).groupBy("segment_key").agg(
        wc.mean_wait().alias("mean"), wc.sd_wait().alias("sd"))
    q = wc.quantiles(wc.merged(wh.agg_visit_cells, ["segment_key"]), ["segment_key"], PROBS)
    found = {r["segment_key"]: r for r in rows.join(q, "segment_key").collect()}
    assert set(found) == set(waits)
    for key, own in waits.items():
        assert found[key]["median"] == pytest.approx(np.percentile(own, 50))
        assert found[key]["p90"] == pytest.approx(np.percentile(own, 90))
        assert found[key]["mean"] == pytest.approx(np.mean(own))
        assert found[key]["sd"] == (pytest.approx(np.std(own, ddof=1)) if len(own) > 1 else None)


def test_series_over_a_column_of_the_cells(wh):
    by_dept = spc.daily_series(wh.agg_visit_cells, ["department_referral"])
    assert by_dept.agg(F.sum("visits")).first()[0] == wh.fct_er_visit.count()


@pytest.mark.parametrize("fn", [metrics.kpi_summary, metrics.monthly_trend, metrics.wait_summary_stats,
                                metrics.satisfaction_by_response_group,
                                lambda wh: metrics.segment_equity_by(wh, "gender"),
                                lambda wh: metrics.wait_quantiles_by(wh, ["month_start", "race"])])
def test_quantile_queries_scan_no_fact(written, fn):
    df = fn(written)
    df.collect()
    plan = df._jdf.queryExecution().toString()
    assert "agg_wait_counts" in plan and "fct_er_visit" not in plan


def test_warehouses_without_counted_tables_count_them(spark, written):
    old = Warehouse(spark, written.marts(), params=written.params)
    assert metrics.kpi_summary(old).collect() == metrics.kpi_summary(written).collect()


def test_load_falls_back_to_the_fact(spark, wh, tmp_path):
    from careflow.sources.sinks import write_marts

    write_marts(wh.marts(), str(tmp_path / "old"))
    old = load_warehouse(spark, str(tmp_path / "old"))
    assert metrics.monthly_trend(old).collect() == metrics.monthly_trend(wh).collect()


def test_quantiles_of_unknown_dimensions(wh):
    with pytest.raises(ValueError):
        metrics.wait_quantiles_by(wh, ["shift"])


# ---------------------------------------------------------------- contexts

def _rounded(df, columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in df.select(*columns).collect()), key=repr)


def test_contexts_equal_their_own_queries(wh):
    contexts = {"all": (), "year": ("year",), "month_gender": ("month_start", "gender"),
                "shift_weekday": ("shift", "day_of_week_num"), "age_department": ("age_band", "department_referral"),
                "hour": ("hour_of_day",), "weekend_month": ("is_weekend", "month_start")}
    one = measures.context_measures(wh, contexts)
    assert one.count() == sum(measures.measures(wh, by).count() for by in contexts.values())
    for name, by in contexts.items():
        own = measures.measures(wh, by)
        assert _rounded(one.where(F.col("context") == name), own.columns) == _rounded(own, own.columns), name
        empty = [c for c in one.columns if c not in own.columns and c != "context"]
        rows = one.where(F.col("context") == name)
        assert not empty or rows.where(" or ".join(f"{c} is not null" for c in empty)).count() == 0


def test_one_scan_of_the_cells_serves_all_contexts(written):
    df = measures.context_measures(written)
    plan = df._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert len(re.findall(r"Scan parquet[^\n]*agg_visit_cells|agg_visit_cells\]", physical)) >= 1
    assert physical.count("Expand [") == 3 or physical.count("Expand") >= 3
    assert "fct_er_visit" not in physical


def test_contexts_must_differ_and_exist(wh):
    for bad in ({"a": ("gender",), "b": ("gender",)}, {"a": ("colour",)}, {"a": ("gender", "race"), "b": ("race", "gender")}):
        with pytest.raises(ValueError):
            measures.context_measures(wh, bad)


def test_contexts_of_an_empty_fact(spark, edge_raw):
    empty = build_warehouse(spark, edge_raw.limit(0))
    assert measures.context_measures(empty).count() == 0


# ---------------------------------------------------------------- prior month

def _visits(spark, rows):
    """(day, gender, department, wait) as a warehouse."""
    from careflow.schema import RAW_COLUMNS

    data = [(f"p{i}", f"{day:%d-%m-%Y} 09:00" if day else None, "X", "X", gender, "40", "White", dept, "TRUE", None,
             str(wait), "0") for i, (day, gender, dept, wait) in enumerate(rows)]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    return build_warehouse(spark, raw, strict_dates=False)


def test_prior_month_under_other_dimensions(spark):
    day = dt.date
    wh = _visits(spark, [
        (day(2024, 1, 5), "F", "A", 10), (day(2024, 1, 31), "F", "A", 50), (day(2024, 1, 9), "M", "A", 10),
        (day(2024, 2, 3), "F", "A", 10), (day(2024, 2, 29), "NC", "B", 20),
        (day(2024, 3, 1), "F", "B", 60), (day(2024, 3, 2), "M", None, 10), (None, "F", "A", 10)])
    got = {(r.month_start, r.gender): r for r in measures.monthly_measures(wh, ("gender",)).collect()}
    jan, feb, mar = day(2024, 1, 1), day(2024, 2, 1), day(2024, 3, 1)
    assert set(got) == {(jan, "F"), (jan, "M"), (feb, "F"), (feb, "M"), (feb, "NC"), (mar, "F"), (mar, "M"), (None, "F")}
    assert (got[feb, "F"].visits, got[feb, "F"].visits_pm, got[feb, "F"].visits_mom_pct) == (1, 2, -0.5)
    assert got[feb, "F"].pct_within_target_delta == pytest.approx(0.5)
    # no men in February: a row of its own, with the men of January
    assert (got[feb, "M"].visits, got[feb, "M"].visits_pm, got[feb, "M"].visits_mom_pct) == (0, 1, -1.0)
    assert got[feb, "M"].pct_within_target is None
    assert got[feb, "NC"].visits_pm is None and got[feb, "NC"].visits_mom_pct is None
    # the calendar ends on 2 March: 1 and 2 March look back at 1 and 2 February, where F had no visit
    assert got[mar, "F"].visits_pm is None
    both = measures.monthly_measures(wh, ("gender", "department_referral")).collect()
    assert {(r.gender, r.department_referral) for r in both if r.month_start == mar} == {("F", "B"), ("M", None)}


def test_prior_month_sums_to_the_month_without_dimensions(wh):
    plain = {r.month_start: r for r in measures.monthly_measures(wh).collect()}
    for by in (("gender",), ("race", "department_referral"), ("shift",), ("hour_of_day",)):
        rows = measures.monthly_measures(wh, by).where("month_start is not null").groupBy("month_start").agg(
            F.sum("visits").alias("v"), F.sum("visits_pm").alias("pm")).collect()
        assert {r.month_start: (r.v, r.pm) for r in rows} == {m: (r.visits, r.visits_pm) for m, r in plain.items()}


def test_calendar_columns_move_with_the_month(wh):
    with pytest.raises(ValueError):
        measures.monthly_measures(wh, ("day_of_week_num",))
