"""Registered queries: one per operator of the inventory, each paired with its
independent DuckDB SQL (``careflow.oracle``).

Every query reads the driver tables of a scale-factor folder, maps them onto raw
visits (``sources.fixtures``), builds the warehouse plans and runs one operator over
the whole input. Floating columns are rounded to 6 decimals for the comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from careflow import oracle
from careflow.functions.stats import round_doubles
from careflow.plans.warehouse import Warehouse, build_warehouse
from careflow.sources.fixtures import visits_from_events, visits_from_lineitem, visits_from_orders

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: QueryFn
    sql: str | None


_SOURCES = {"lineitem": visits_from_lineitem, "events": visits_from_events,
            "orders": visits_from_orders}


def raw_visits(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> DataFrame:
    return _SOURCES[source](spark, sf_dir)


def warehouse(spark: SparkSession, sf_dir: str, source: str = "lineitem") -> Warehouse:
    return build_warehouse(spark, raw_visits(spark, sf_dir, source))


REGISTRY: dict[str, Query] = {}


def register(name: str, sql_body: str | None, source: str = "lineitem",
             doubles: tuple[str, ...] = (), extra_ctes: str = ""):
    """Decorator: ``fn(wh) -> DataFrame`` becomes a (spark, sf_dir) query."""

    def deco(fn: Callable[[Warehouse], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(warehouse(spark, sf_dir, source)))

        sql = (oracle.with_models(sql_body, source, doubles, extra_ctes)
               if sql_body is not None else None)
        REGISTRY[name] = Query(name, build, sql)
        return fn

    return deco


def mart_query(name: str, table: str, doubles: tuple[str, ...] = (), sources=("lineitem",)):
    for source in sources:
        register(name + oracle.SUFFIX[source], f"select * from {table}", source, doubles)(
            lambda wh, _t=table: wh.table(_t)
        )


STG_DOUBLES = ("satisfaction_score",)
DAILY_DOUBLES = (
    "median_wait_minutes", "p90_wait_minutes", "wait_centre_line", "wait_ucl", "wait_lcl",
    "admission_rate", "admit_centre_line", "admit_ucl", "admit_lcl",
)
SEG_DOUBLES = ("median_wait_minutes", "p90_wait_minutes", "mean_wait_minutes", "ci_lower", "ci_upper")

for _source, _suffix in oracle.SUFFIX.items():
    register(f"m1_stg_visits{_suffix}", "select * from stg", _source, STG_DOUBLES)(lambda wh: wh.stg_er_visits)
mart_query("m2_dim_date", "dim_date", sources=tuple(oracle.SUFFIX))
mart_query("m3_dim_time_of_day", "dim_time_of_day", sources=tuple(oracle.SUFFIX))
mart_query("m4_dim_patient_segment", "dim_patient_segment", sources=tuple(oracle.SUFFIX))
mart_query("m5_dim_department", "dim_department", sources=tuple(oracle.SUFFIX))
mart_query("m6_fct_visit", "fct_er_visit", STG_DOUBLES, sources=tuple(oracle.SUFFIX))
mart_query("m7_hourly_arrivals", "agg_hourly_arrivals", ("median_wait_minutes",), sources=tuple(oracle.SUFFIX))
mart_query("m8_daily_ops", "agg_daily_ops", DAILY_DOUBLES, sources=tuple(oracle.SUFFIX))
mart_query("m9_segment_waits", "agg_segment_waits", SEG_DOUBLES, sources=tuple(oracle.SUFFIX))



def _metric_functions() -> dict[str, Callable[[Warehouse], DataFrame]]:
    from careflow.operators import metrics as m

    fns: dict[str, Callable[[Warehouse], DataFrame]] = {
        "q01_kpi_summary": m.kpi_summary,
        "q02_monthly_trend": m.monthly_trend,
        "q03_demand_by_weekday": m.demand_by_weekday,
        "q04_demand_by_hour": m.demand_by_hour,
        "q05_demand_heatmap": m.demand_heatmap,
        "q05p_heatmap_matrix": m.demand_heatmap_matrix,
        "q05o_heatmap_row_order": m.heatmap_row_order,
        "q06_demand_volume_stats": m.demand_volume_stats,
        "q07_wait_summary_stats": m.wait_summary_stats,
        "q08_wait_histogram": m.wait_histogram,
        "q08s_wait_histogram_source_bins": lambda wh: m.wait_histogram(wh, 5, source_bins=True),
        "q09_wait_within_target": m.wait_within_target,
        "q10_wait_daily_trend": m.wait_daily_trend,
        "q11_load_vs_wait_hourly": m.load_vs_wait_hourly,
        "q12_load_vs_wait_correlation": m.load_vs_wait_correlation,
        "q12f_load_vs_wait_fit": m.load_vs_wait_fit,
        "q13_load_quintiles": m.load_vs_wait_quintiles,
        "q14_spc_wait_chart": m.spc_wait_chart,
        "q15_spc_admit_chart": m.spc_admit_chart,
        "q16_spc_signal_days": m.spc_signal_days,
        "q16s_spc_summary": m.spc_summary,
        "q17_satisfaction_overview": m.satisfaction_overview,
        "q18_satisfaction_by_wait_bucket": m.satisfaction_by_wait_bucket,
        "q19_satisfaction_by_admitted": m.satisfaction_by_admitted,
        "q20a_nonresponse_bias": m.satisfaction_nonresponse_bias,
        "q20b_response_groups": m.satisfaction_by_response_group,
        "q21o_equity_age_band_ordered": m.segment_equity_by_age_band_ordered,
        "q22_equity_extremes": m.segment_equity_extremes,
        "q23_low_n_summary": m.segment_low_n_summary,
        "q24_row_counts": m.row_counts,
        "q25_null_report": m.null_report,
        "q26_date_coverage": m.date_coverage_check,
        "q27_duplicate_check": m.duplicate_check,
        "q28_invalid_values": m.invalid_value_check,
        "q29_data_quality_summary": m.data_quality_summary,
        "q31_extremes_chart": m.extremes_chart_frame,
    }
    for name, by in {"month_department": ["month_start", "department_referral"],
                     "gender_weekday": ["gender", "day_name"], "all": []}.items():
        fns[f"a8_wait_quantiles_{name}"] = lambda wh, _b=by: m.wait_quantiles_by(wh, _b)
    for dim in m.EQUITY_DIMENSIONS:
        fns[f"q21_equity_{dim}"] = lambda wh, _d=dim: m.segment_equity_by(wh, _d)
    for col in m.DISTRIBUTION_COLUMNS:
        fns[f"q30_dist_{col}"] = lambda wh, _c=col: m.category_distribution(wh, _c)
    return fns


_LOADED = False


def _load() -> None:
    global _LOADED
    if _LOADED:
        return
    fns = _metric_functions()
    for name, (source, body, doubles) in oracle.METRICS.items():
        register(name, body, source, doubles)(fns[name.removesuffix(oracle.SUFFIX[source])])
    from careflow.operators import measures, profile, quality
    from careflow.plans import round_trip

    for mod in (measures, quality, profile, round_trip):
        for name, spec in getattr(mod, "QUERIES", {}).items():
            source, body, doubles, fn = spec[:4]
            register(name, body, source, doubles, spec[4] if len(spec) > 4 else "")(fn)
    _LOADED = True


def queries() -> dict[str, QueryFn]:
    _load()
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
