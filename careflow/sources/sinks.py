"""Sinks: the parquet warehouse (marts materialized as tables) and the CSV export.

Writes are idempotent overwrites of whole folders, so a job that is retried after a
lost executor or driver rewrites the same result.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.schema import MART_TABLES

# Aggregates whose row count is bounded by the calendar; they are written as one file each
# (after their parallel aggregation). Segments and departments are free text: unbounded.
SMALL_MARTS = {"agg_daily_ops", "dim_date", "dim_time_of_day"}


def _write_one(name: str, df: DataFrame, target: str, mode: str) -> None:
    if name == "fct_er_visit":
        # dates in ranges, so that a month's rows lie in few files; a crowded date is split by id
        df = (df.repartitionByRange("visit_date", "visit_hour", "visit_id")
              .sortWithinPartitions("visit_date", "visit_hour", "segment_key", "department_referral", "wait_minutes"))
    elif name == "agg_visit_cells":
        # a date's rows together: they and what is counted from them next take less room
        df = df.sortWithinPartitions("visit_date", "segment_key", "department_referral", "wait_minutes")
    elif name in SMALL_MARTS:
        df = df.repartition(1)
    df.write.mode(mode).option("compression", "zstd").parquet(target)


def write_marts(marts: dict[str, DataFrame], path: str, mode: str = "overwrite",
                parallel_jobs: int = 4) -> dict[str, str]:
    """Each mart to ``path/<name>`` as parquet. The fact is range-partitioned and
    sorted by visit date, so date filters skip files and row groups by their statistics.

    The marts are independent jobs over the same input; up to ``parallel_jobs`` are
    submitted at once from driver threads (Spark schedules concurrent jobs), so small
    dimension jobs do not leave the cluster idle behind each other.
    """
    out = {name: f"{path.rstrip('/')}/{name}" for name in marts}
    if parallel_jobs <= 1 or len(marts) <= 1:
        for name, df in marts.items():
            _write_one(name, df, out[name], mode)
        return out
    with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
        futures = [pool.submit(_write_one, name, df, out[name], mode) for name, df in marts.items()]
        for f in futures:
            f.result()  # re-raise the first failure
    return out


def read_marts(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Table scans of written marts."""
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in (names or MART_TABLES)}


def read_marts_if_there(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables among ``names`` that were written (older folders have fewer)."""
    out = {}
    for name in names:
        try:
            out |= read_marts(spark, path, [name])
        except AnalysisException:
            continue
    return out


def _write_csv(df: DataFrame, target: str, small: bool, keep_lone_nulls: bool,
               seen: Observation | None = None, compression: str = "none") -> None:
    if small:
        df = df.repartition(1)
    if seen is not None:
        # Behind the last shuffle: counted by the tasks that write, once each.
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    alone = keep_lone_nulls and len(df.columns) == 1
    df.write.mode("overwrite").option("header", True).option("quoteAll", alone).option("compression", compression).csv(target)


def export_csv(marts: dict[str, DataFrame], out_dir: str,
               single_file_small: bool = True, keep_lone_nulls: bool = True,
               compression: str = "none") -> dict[str, str]:
    """Every mart to ``out_dir/<name>/`` as CSV with a header row.

    Small calendar/segment-bounded marts may go to one file; the fact always stays
    partitioned. One file is made with ``repartition(1)``, a shuffle of the finished
    (small) rows, not ``coalesce(1)``, which would pull the upstream aggregation that
    merges every map task's partial result into a single task. A NULL row of a one-column
    mart would be a blank line, which readers skip: such a mart's values are quoted, so that the
    row is read back, unless ``keep_lone_nulls`` is off. ``compression``: as Spark's CSV writer has it.
    """
    out = {}
    for name, df in marts.items():
        out[name] = f"{out_dir.rstrip('/')}/{name}"
        _write_csv(df, out[name], single_file_small and name in SMALL_MARTS, keep_lone_nulls, compression=compression)
    return out


def export_counted(spark: SparkSession, marts: dict[str, DataFrame], out_dir: str,
                   single_file_small: bool = True, keep_lone_nulls: bool = True) -> DataFrame:
    """S7 with its report: (table_name, path, export_rows, export_columns) of every file folder,
    counted by the writing tasks themselves, so that a mart is scanned once."""
    found = []
    for name, df in marts.items():
        seen, target = Observation(name), f"{out_dir.rstrip('/')}/{name}"
        _write_csv(df, target, single_file_small and name in SMALL_MARTS, keep_lone_nulls, seen)
        found.append((name, target, seen.get["rows"], len(df.columns)))
    return spark.createDataFrame(found, "table_name string, path string, export_rows long, export_columns int")


def write_params(spark: SparkSession, params: MeasureParams, path: str) -> None:
    """The measure parameters beside the marts, one row."""
    target = f"{path.rstrip('/')}/measure_params"
    spark.createDataFrame([asdict(params)]).coalesce(1).write.mode("overwrite").parquet(target)


def read_params(spark: SparkSession, path: str) -> MeasureParams:
    """The parameters a warehouse was built with; the defaults where none are stored."""
    try:
        row = spark.read.parquet(f"{path.rstrip('/')}/measure_params").first()
    except AnalysisException:  # written before parameters were stored
        return DEFAULT_PARAMS
    return MeasureParams(**row.asDict())
