"""Command line: the warehouse workflows as Spark jobs.

    python -m careflow build   --raw PATH --out WAREHOUSE      # staging + 8 marts (parquet)
    python -m careflow refresh --landing DIR --out WAREHOUSE   # new files -> marts of their dates
    python -m careflow export  --warehouse WAREHOUSE --out DIR  # marts -> CSV + row and column counts
    python -m careflow check   --warehouse WAREHOUSE           # the 34 data tests
    python -m careflow profile --raw PATH [--out DIR]          # R1-R7 of a raw CSV
    python -m careflow metric  --warehouse WAREHOUSE NAME      # one metric, shown

Under spark-submit the session (master, resources, checkpoint folder) comes from the
cluster; ``configure`` only fills in unset settings.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from careflow.operators import metrics, profile, quality
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.plans.warehouse import build_warehouse, load_warehouse, materialize
from careflow.session import configure
from careflow.sources.raw_csv import malformed_rows, read_csv_for_profile, read_raw_visits
from careflow.sources.sinks import export_counted
from careflow.streaming import refresh_landing, refreshed_warehouse

METRICS = {
    "kpi_summary": metrics.kpi_summary,
    "monthly_trend": metrics.monthly_trend,
    "demand_by_weekday": metrics.demand_by_weekday,
    "demand_by_hour": metrics.demand_by_hour,
    "demand_heatmap": metrics.demand_heatmap,
    "demand_volume_stats": metrics.demand_volume_stats,
    "wait_summary_stats": metrics.wait_summary_stats,
    "wait_histogram": metrics.wait_histogram,
    "wait_within_target": metrics.wait_within_target,
    "wait_daily_trend": metrics.wait_daily_trend,
    "load_vs_wait_correlation": metrics.load_vs_wait_correlation,
    "load_vs_wait_quintiles": metrics.load_vs_wait_quintiles,
    "spc_wait_chart": metrics.spc_wait_chart,
    "spc_admit_chart": metrics.spc_admit_chart,
    "spc_signal_days": metrics.spc_signal_days,
    "satisfaction_overview": metrics.satisfaction_overview,
    "satisfaction_nonresponse_bias": metrics.satisfaction_nonresponse_bias,
    "segment_equity_extremes": metrics.segment_equity_extremes,
    "segment_low_n_summary": metrics.segment_low_n_summary,
    "row_counts": metrics.row_counts,
    "null_report": metrics.null_report,
    "date_coverage_check": metrics.date_coverage_check,
    "duplicate_check": metrics.duplicate_check,
    "invalid_value_check": metrics.invalid_value_check,
}


def _session() -> SparkSession:
    return configure(SparkSession.builder.appName("careflow").getOrCreate())


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="careflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--lenient-dates", action="store_true")
    b.add_argument("--target", type=int, default=DEFAULT_PARAMS.wait_target_minutes)
    b.add_argument("--max-plausible", type=int, default=DEFAULT_PARAMS.max_plausible_wait_minutes)
    b.add_argument("--sigma", type=float, default=DEFAULT_PARAMS.spc_sigma)
    e = sub.add_parser("export")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--out", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--landing", required=True)
    r.add_argument("--out", required=True)
    c = sub.add_parser("check")
    c.add_argument("--warehouse", required=True)
    p = sub.add_parser("profile")
    p.add_argument("--raw", required=True)
    p.add_argument("--out")
    m = sub.add_parser("metric")
    m.add_argument("--warehouse", required=True)
    m.add_argument("name", choices=sorted(METRICS))
    args = ap.parse_args(argv)
    spark = _session()

    if args.cmd == "build":
        raw = read_raw_visits(spark, args.raw)
        malformed_rows(spark, args.raw).show(truncate=False)
        params = MeasureParams(wait_target_minutes=args.target, max_plausible_wait_minutes=args.max_plausible,
                               spc_sigma=args.sigma)
        wh = materialize(build_warehouse(spark, raw, params, strict_dates=not args.lenient_dates), args.out)
        quality.reconciliation(wh).show(truncate=False)
    elif args.cmd == "export":
        wh = load_warehouse(spark, args.warehouse)
        export_counted(spark, wh.marts(), args.out).show(truncate=False)
    elif args.cmd == "refresh":
        refresh_landing(spark, args.landing, args.out, f"{args.out.rstrip('/')}/_stream").awaitTermination()
        refreshed_warehouse(spark, args.out).agg_daily_ops.orderBy("visit_date").show(5, truncate=False)
    elif args.cmd == "check":
        wh = load_warehouse(spark, args.warehouse, with_staging=True)
        res = quality.run_checks(wh)
        res.orderBy("check_id").show(50, truncate=False)
        return 1 if res.filter("status = 'fail'").limit(1).count() else 0
    elif args.cmd == "profile":
        raw = read_csv_for_profile(spark, args.raw)
        vc = profile.counted_values(raw)
        parts = {
            "overview": profile.overview(raw),
            "columns": profile.column_summary(raw, vc).orderBy("position"),
            "value_counts": profile.low_cardinality_values(raw, vc=vc).orderBy("column", "rank"),
            "numeric": profile.numeric_describe(raw, vc=vc),
            "datetimes": profile.datetime_columns(raw, vc=vc),
            "layouts": profile.datetime_layouts(raw, vc).orderBy("column"),
        }
        for name, df in parts.items():
            if args.out:
                df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
            else:
                print(f"--- {name} ---")
                df.show(100, truncate=False)
    elif args.cmd == "metric":
        wh = load_warehouse(spark, args.warehouse)
        METRICS[args.name](wh).show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
