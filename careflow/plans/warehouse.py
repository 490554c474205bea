"""The warehouse build: raw visits -> staging -> 8 marts.

``build_warehouse`` returns lazy DataFrames: nothing runs until a mart or metric is
written or collected, except that the first access to the cells and to the daily mart
checkpoints them. ``materialize`` writes the marts as parquet tables to a shared
folder and returns a warehouse that scans them: the metric layer then reads small
pre-aggregated tables, and a lost executor only recomputes from the written files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from careflow.operators import dims, marts, spc, staging, wait_counts
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.schema import COUNTED_TABLES, MART_TABLES
from careflow.session import kept
from careflow.sources import sinks


class Warehouse:
    """The staging table and the 8 marts of one build, and the two tables of counted waits that
    marts and metrics are read from (``agg_visit_cells``, ``agg_wait_counts``).

    Marts are given as DataFrames or as zero-argument builders; a builder runs on first
    access only (building the cells or the daily mart checkpoints a table, a job that a
    query not reading it should not pay for).
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]],
                 stg_er_visits: DataFrame | None = None, raw_visits: DataFrame | None = None,
                 params: MeasureParams = DEFAULT_PARAMS):
        missing = set(MART_TABLES) - set(tables)
        if missing:
            raise ValueError(f"missing marts: {sorted(missing)}")
        self.spark = spark
        self.stg_er_visits = stg_er_visits
        self.raw_visits = raw_visits
        self.params = params
        self._tables = {"agg_visit_cells": self._cells, "agg_wait_counts": self._counts,
                        "agg_hour_counts": self._hours, **tables}

    def _cells(self) -> DataFrame:
        # Read by many branches of a plan: aggregated once, its lineage cut in the shared folder.
        return kept(wait_counts.visit_cells(self.fct_er_visit), "cells")

    def _hours(self) -> DataFrame:
        # From the cells if they are at hand, else straight from the visits, so that a query of
        # daily or hourly rows alone does not pay for the cells.
        cells = self._tables["agg_visit_cells"]
        rows = cells if isinstance(cells, DataFrame) else self.fct_er_visit
        return kept(wait_counts.hour_counts(rows), "hours")

    def _counts(self) -> DataFrame:
        return wait_counts.wait_counts(self.agg_visit_cells)

    def table(self, name: str) -> DataFrame:
        t = self._tables[name]
        if not isinstance(t, DataFrame):
            t = t()
            self._tables[name] = t
        return t

    def with_cells(self) -> "Warehouse":
        """Build the cells first, for what reads them beside the daily or hourly mart: those are
        then read from the cells, not from the visits once more."""
        if not all(isinstance(self._tables[name], DataFrame) for name in MART_TABLES):
            self.table("agg_visit_cells")
        return self

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name in tables:
            return self.table(name)
        raise AttributeError(name)

    def marts(self) -> dict[str, DataFrame]:
        self.with_cells()
        return {name: self.table(name) for name in MART_TABLES}


def build_warehouse(spark: SparkSession, raw: DataFrame, params: MeasureParams = DEFAULT_PARAMS,
                    strict_dates: bool = True, stg: DataFrame | None = None,
                    written: dict[str, DataFrame] | None = None) -> Warehouse:
    """Lazy plans of all marts over one staging DataFrame; tables in ``written`` as given.

    Only the fact and the segment dimension read staging; everything else reads the cells, the
    one aggregation over all visits.
    """
    if stg is None:
        stg = staging.stage_visits(raw, params, strict_dates=strict_dates)
    tables = {
        "fct_er_visit": marts.fct_er_visit(stg, params),
        "dim_patient_segment": dims.dim_patient_segment(stg),
        "agg_daily_ops": lambda: spc.agg_daily_ops(wh.agg_hour_counts, params),
        "agg_hourly_arrivals": lambda: marts.agg_hourly_arrivals(wh.agg_hour_counts),
        "agg_segment_waits": lambda: marts.agg_segment_waits(wh.agg_visit_cells, wh.dim_patient_segment, params),
        "dim_date": lambda: dims.dim_date(wh.agg_hour_counts),
        "dim_time_of_day": lambda: dims.dim_time_of_day(spark, wh.agg_hour_counts),
        "dim_department": lambda: dims.dim_department(wh.agg_visit_cells),
    }
    wh = Warehouse(spark, tables | (written or {}), stg_er_visits=stg, raw_visits=raw, params=params)
    return wh


def materialize(wh: Warehouse, path: str) -> Warehouse:
    """Write staging once, the cells from the written staging, the marts from both, and return a
    warehouse reading the written tables.

    Staging is written first so that its readers do not each re-parse the raw input, the fact next,
    from which the cells are counted (it lies in the order of dates, so their shuffle packs well),
    because the other marts read them; every write is a whole-folder overwrite, safe to retry.
    """
    spark, raw, params = wh.spark, wh.raw_visits, wh.params
    base = path.rstrip("/")
    written: dict[str, DataFrame] = {}
    if wh.stg_er_visits is not None:
        wh.stg_er_visits.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/stg_er_visits")
        stg = spark.read.parquet(f"{base}/stg_er_visits")
        for name, rows in (("fct_er_visit", lambda: marts.fct_er_visit(stg, params)),
                           ("agg_visit_cells", lambda: wait_counts.visit_cells(written["fct_er_visit"]))):
            sinks.write_marts({name: rows()}, base)
            written |= sinks.read_marts(spark, base, [name])
        wh = build_warehouse(spark, raw=raw, params=params, stg=stg, written=written)
    counted = {name: wh.table(name) for name in COUNTED_TABLES if name not in written}
    rest = {name: df for name, df in wh.marts().items() if name not in written}
    sinks.write_marts(rest | counted, base)
    sinks.write_params(spark, params, base)
    out = load_warehouse(spark, base, params, with_staging=True)
    out.raw_visits = raw
    return out


def load_warehouse(spark: SparkSession, path: str, params: MeasureParams | None = None,
                   with_staging: bool = False) -> Warehouse:
    """A written warehouse, with the parameters it was built with unless others are given."""
    tables = sinks.read_marts(spark, path) | sinks.read_marts_if_there(spark, path, COUNTED_TABLES)
    params = params or sinks.read_params(spark, path)
    stg = spark.read.parquet(f"{path.rstrip('/')}/stg_er_visits") if with_staging else None
    return Warehouse(spark, tables, stg_er_visits=stg, params=params)
