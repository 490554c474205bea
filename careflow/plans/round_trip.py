"""Sources and sinks in one pass: raw visits written as a CSV folder, read back, typed, the
marts written, loaded and exported, the exports read again.

Every step is a distributed write into a folder of its own below the shared checkpoint
folder, followed by a scan of it; nothing passes through the driver.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from careflow.operators import profile, quality
from careflow.oracle import SUFFIX
from careflow.plans.warehouse import Warehouse, build_warehouse, load_warehouse, materialize
from careflow.schema import MART_TABLES, RAW_COLUMNS, RAW_HEADER
from careflow.session import checkpoint_dir
from careflow.sources.raw_csv import read_csv_for_profile, read_raw_visits
from careflow.sources.sinks import export_counted, export_csv
from careflow.streaming.refresh import refresh_landing, refreshed_warehouse


LANDED = 6  # files at least, so that every batch takes in several


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/careflow-round-trip/{uuid.uuid4().hex}"


def write_raw_csv(raw: DataFrame, path: str) -> str:
    """Raw visits as a landing folder: the source's header, blanks around values kept; gzip files,
    one of each task."""
    (raw.select(*RAW_COLUMNS).toDF(*RAW_HEADER).write.option("header", True).option("compression", "gzip")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def written_warehouse(wh: Warehouse) -> Warehouse:
    """The warehouse rebuilt from a written CSV folder, its tables written and loaded."""
    folder = _folder(wh.spark)
    raw = read_raw_visits(wh.spark, write_raw_csv(wh.raw_visits, f"{folder}/raw"))
    materialize(build_warehouse(wh.spark, raw, wh.params), f"{folder}/warehouse")
    return load_warehouse(wh.spark, f"{folder}/warehouse", with_staging=True)


def profile_of_csv(wh: Warehouse) -> DataFrame:
    """S3: the column summary of a written CSV folder."""
    path = write_raw_csv(wh.raw_visits, f"{_folder(wh.spark)}/raw")
    return profile.column_summary(read_csv_for_profile(wh.spark, path).toDF(*RAW_COLUMNS))


def exported(wh: Warehouse) -> DataFrame:
    """The exported files of every mart against the mart."""
    marts = written_warehouse(wh).marts()
    files = export_csv(marts, f"{_folder(wh.spark)}/exports", compression="gzip")
    back = {name: wh.spark.read.option("header", True).csv(path) for name, path in files.items()}
    return quality.export_reconciliation(marts, back)


def export_report(wh: Warehouse) -> DataFrame:
    """Rows and columns of every mart's export, counted while it is written."""
    return export_counted(wh.spark, wh.marts(), f"{_folder(wh.spark)}/exports").drop("path")


def refreshed(wh: Warehouse) -> Warehouse:
    """S6, incrementally: the raw visits landed as files whose dates overlap, taken in by a stream
    a third of the files at a time (two of six, where the visits are few)."""
    folder = _folder(wh.spark)
    landing = write_raw_csv(wh.raw_visits, f"{folder}/landing")
    files = len(wh.spark.read.text(landing).inputFiles())
    if files < LANDED:
        files, landing = LANDED, write_raw_csv(wh.raw_visits.repartition(LANDED), f"{folder}/landing-few")
    refresh_landing(wh.spark, landing, f"{folder}/warehouse", f"{folder}/checkpoint", wh.params,
                    max_files_per_trigger=math.ceil(files / 3), grain="year").awaitTermination()
    return refreshed_warehouse(wh.spark, f"{folder}/warehouse")


_EXPORT_SQL = " union all ".join(
    f"""select '{t}' as table_name, count(*) as mart_rows, count(*) as export_rows,
        any_value(len(json_keys(to_json(t))))::int as mart_columns,
        any_value(len(json_keys(to_json(t))))::int as export_columns, true as reconciled from {t} t"""
    for t in MART_TABLES)

_REPORT_SQL = " union all ".join(
    f"""select '{t}' as table_name, count(*) as export_rows,
        any_value(len(json_keys(to_json(t))))::int as export_columns from {t} t""" for t in MART_TABLES)

QUERIES = {}
for _src in ("lineitem", "events", "orders"):
    QUERIES[f"s7_export_report{SUFFIX[_src]}"] = (_src, _REPORT_SQL, (), export_report)
_DAILY = ("median_wait_minutes", "p90_wait_minutes", "wait_centre_line", "wait_ucl", "wait_lcl", "admission_rate",
          "admit_centre_line", "admit_ucl", "admit_lcl")
_SEGMENT = ("median_wait_minutes", "p90_wait_minutes", "mean_wait_minutes", "ci_lower", "ci_upper")
QUERIES["s6_refresh_daily_ops"] = ("lineitem", "select * from agg_daily_ops", _DAILY,
                                   lambda wh: refreshed(wh).agg_daily_ops)
QUERIES["s6_refresh_segment_waits_dirty"] = ("orders", "select * from agg_segment_waits", _SEGMENT,
                                             lambda wh: refreshed(wh).agg_segment_waits)
QUERIES["s6_refresh_fact_ev"] = ("events", "select * from fct_er_visit", ("satisfaction_score",),
                                 lambda wh: refreshed(wh).fct_er_visit)
for _src in ("lineitem", "events", "orders"):
    QUERIES[f"s1_s4_s6_staging_round_trip{SUFFIX[_src]}"] = (
        _src, "select * from stg", ("satisfaction_score",), lambda wh: written_warehouse(wh).stg_er_visits)
    QUERIES[f"s7_d5_export_round_trip{SUFFIX[_src]}"] = (_src, _EXPORT_SQL, (), exported)
    QUERIES[f"s3_profile_round_trip{SUFFIX[_src]}"] = (
        _src, profile.SQL["r2"], ("null_pct",), profile_of_csv, profile.SQL["pre"])
