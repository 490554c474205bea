"""Randomized differential test: messy raw visit files through the Spark warehouse and
through the independent DuckDB SQL (careflow.oracle) must give the same results."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from careflow import oracle
from careflow.operators import measures, metrics, quality
from careflow.plans.warehouse import build_warehouse
from careflow.schema import RAW_COLUMNS

from harness import rows_of

GENDERS = ["M", "F", "NC", " M ", "X", None]
RACES = ["White", "Asian", "African American", None]
DEPTS = ["None", "Cardiology", "Orthopedics", None, " Renal "]
ADMIT = ["TRUE", "FALSE", " true", "false", None, "yes"]
WAITS = [None, "abc", "-3", "241", "240", "30", "31", "12.6", "7.5"]


def random_raw(seed: int, n: int = 400) -> list[tuple]:
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        ts = start + dt.timedelta(days=rnd.randint(0, 90) if rnd.random() > 0.02 else 120,
                                  hours=rnd.randint(0, 23), minutes=rnd.randint(0, 59))
        d = f"{ts.day}-{ts.month}-{ts.year} {ts.hour}:{ts.minute}" if rnd.random() < 0.3 else ts.strftime(
            "%d-%m-%Y %H:%M")
        wait = rnd.choice(WAITS) if rnd.random() < 0.15 else str(max(1, int(rnd.gauss(35, 12))))
        out.append((
            f"V{i if rnd.random() > 0.01 else 0}", d, "A", "B", rnd.choice(GENDERS),
            rnd.choice([None, "x", "4.5", str(rnd.randint(1, 90))]) if rnd.random() < 0.1 else str(rnd.randint(1, 90)),
            rnd.choice(RACES), rnd.choice(DEPTS), rnd.choice(ADMIT),
            str(rnd.randint(0, 11)) if rnd.random() < 0.3 else None,
            wait, rnd.choice(["0", "1", " 1"]),
        ))
    return out


CASES = {
    "daily": (lambda wh: wh.agg_daily_ops, "select * from agg_daily_ops"),
    "hourly": (lambda wh: wh.agg_hourly_arrivals, "select * from agg_hourly_arrivals"),
    "segments": (lambda wh: wh.agg_segment_waits, "select * from agg_segment_waits"),
    "dim_time": (lambda wh: wh.dim_time_of_day, "select * from dim_time_of_day"),
    "fact": (lambda wh: wh.fct_er_visit, "select * from fct_er_visit"),
}
for name in ("q01_kpi_summary", "q02_monthly_trend", "q03_demand_by_weekday", "q06_demand_volume_stats",
             "q07_wait_summary_stats", "q08_wait_histogram", "q13_load_quintiles",
             "q18_satisfaction_by_wait_bucket", "q20a_nonresponse_bias", "q20b_response_groups",
             "q21_equity_age_band", "q22_equity_extremes", "q25_null_report", "q26_date_coverage",
             "q27_duplicate_check", "q28_invalid_values"):
    CASES[name] = name


def _metric_fn(name):
    from careflow.plans.catalog import _metric_functions

    return _metric_functions()[name]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_raw_files_match_oracle(spark, seed):
    from careflow.functions.stats import round_doubles

    rows = random_raw(seed)
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    wh = build_warehouse(spark, raw)
    con = duckdb.connect()
    con.register("raw_input", pd.DataFrame(rows, columns=RAW_COLUMNS))
    failures = {}
    for key, case in CASES.items():
        if isinstance(case, str):
            source, body, doubles = oracle.METRICS[case]
            fn = _metric_fn(case)
        else:
            fn, body = case
            doubles = tuple(f.name for f in fn(wh).schema.fields if f.dataType.typeName() == "double")
        sql = oracle.with_models(body, "lineitem", doubles).replace(
            oracle.RAW_LINEITEM.strip(), "raw as (select * from raw_input)")
        ours = round_doubles(fn(wh)).toPandas()
        theirs = con.sql(sql).df()
        if sorted(ours.columns) != sorted(theirs.columns) or rows_of(ours) != rows_of(theirs):
            failures[key] = (len(ours), len(theirs))
    assert not failures, failures


def test_measures_on_random_raw(spark):
    rows = random_raw(3)
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    wh = build_warehouse(spark, raw)
    m = measures.monthly_measures(wh).collect()
    assert sum(r["visits"] for r in m) == 400
    assert quality.run_checks(wh).filter("status = 'fail'").count() > 0
    assert metrics.kpi_summary(wh).first()["visits"] == 400
