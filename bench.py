"""Benchmark: build the warehouse from the driver tables, then time the headline
queries of the baseline over the written marts.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: ``{"metric", "value", "unit", "queries": {name: sec}, "sf", ...}``.
Each query: one warm-up run, then the median of 5 timed runs (results collected; they
are small). ``value`` is the sum of the query medians; the one-off warehouse build
(raw mapping -> staging -> 8 marts, written as parquet) and two registered queries, which
start from the driver tables, are reported separately. A folder of a tenth of the scale beside
``BENCH_SF_DIR`` is measured the same way: ``growth`` is the factor from it to the full scale.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from careflow.operators import metrics, quality
from careflow.plans import catalog
from careflow.plans.warehouse import build_warehouse, materialize
from careflow.session import local_session
from careflow.sources.fixtures import visits_from_lineitem

HEADLINE = {
    "kpi_summary": metrics.kpi_summary,
    "monthly_trend": metrics.monthly_trend,
    "demand_heatmap": metrics.demand_heatmap,
    "wait_summary_stats": metrics.wait_summary_stats,
    "spc_wait_chart": metrics.spc_wait_chart,
    "segment_equity_extremes": metrics.segment_equity_extremes,
    "data_quality_report": lambda wh: list(metrics.data_quality_report(wh).values()),
    "load_vs_wait_quintiles": metrics.load_vs_wait_quintiles,
    "data_tests_34": quality.run_checks,
}


def _run(result) -> None:
    frames = result if isinstance(result, list) else [result]
    for df in frames:
        df.collect()


def _time(fn, wh, repeats: int = 5) -> float:
    _run(fn(wh))  # warm-up
    samples = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        _run(fn(wh))
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


REGISTERED = ("q16_spc_signal_days", "x1_x9_total_measures")


def _measure(spark, sf_dir: str) -> dict:
    t0 = time.perf_counter()
    raw = visits_from_lineitem(spark, sf_dir)
    wh = materialize(build_warehouse(spark, raw), tempfile.mkdtemp(prefix="careflow-bench-"))
    build_sec = time.perf_counter() - t0
    queries = {name: round(_time(fn, wh), 4) for name, fn in HEADLINE.items()}
    registered = {}
    for name in REGISTERED:
        t0 = time.perf_counter()
        catalog.queries()[name](spark, sf_dir).collect()
        registered[name] = round(time.perf_counter() - t0, 4)
    return {"value": round(sum(queries.values()), 4), "queries": queries, "registered": registered,
            "build_warehouse_sec": round(build_sec, 3), "visits": wh.fct_er_visit.count()}


def _scale(sf_dir: str) -> float | None:
    m = re.search(r"sf([0-9.]+)/?$", sf_dir)
    return float(m.group(1)) if m else None


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = _scale(sf_dir)
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app_name="careflow-bench")
    result = {"metric": "headline_queries_total_sec", "unit": "sec", "sf": sf, "cpus": cpus,
              **_measure(spark, sf_dir)}
    tenth = os.path.join(os.path.dirname(sf_dir.rstrip("/")), f"sf{sf / 10:g}") if sf else ""
    if os.path.isdir(tenth):
        small = _measure(spark, tenth)
        result["tenth"] = {"sf": _scale(tenth), **small}
        result["growth"] = {name: round(sec / small["queries"][name], 2)
                            for name, sec in result["queries"].items()}
        result["growth"]["build_warehouse"] = round(
            result["build_warehouse_sec"] / small["build_warehouse_sec"], 2)
    print(json.dumps(result))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
