"""Incremental refresh: a landed batch replaces the rows of its own dates, nothing else.

Staging, fact, cells and segment members are kept in one partition per visit date and batch (or
month or year and batch, where dates are small), the hourly and daily tables in one per date. A batch

1. is typed and written to staging under its batch number, replacing what an earlier try of the
   same batch left there;
2. adds its fact rows, its cells (sums that add up over batches) and its segment members likewise:
   no visit of an earlier batch is read or written again;
3. names the dates it touches, and those dates' partitions of the hourly and daily tables are
   computed from all of their cells and overwritten (dynamic partition overwrite);
4. rewrites the tables without a date of their own (control charts, segment waits, dimensions) from
   the dated aggregates: calendar- or segment-bounded work, no visit is read again.

Every step replaces whole partitions from what lies in staging, so a batch that is replayed after a
failure, at any point, gives the same tables, and a late file costs its own rows and the cells of its
dates, however long the history is. The result equals a full rebuild over all files.

Visits without a readable date share the partition of the NULL date. The partitions of a batch
are collected to the driver: at most the calendar's days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from careflow.operators import dims, marts, spc
from careflow.operators import wait_counts as wc
from careflow.operators.staging import stage_visits
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.plans.warehouse import Warehouse
from careflow.schema import RAW_COLUMNS, RAW_SCHEMA, STAGING_COLUMNS
from careflow.session import checkpoint_dir
from careflow.sources import sinks

SEGMENT_COLUMNS = ["segment_key", "age_band", "gender", "race"]


class DatedTables:
    """The tables of a warehouse folder that are kept in partitions of dates. ``grain``: the dates
    of a partition, ``day`` (each on its own), ``month`` or ``year``; for sparse data, so that a
    partition is worth its files. Part of the folder: every batch uses the same."""

    def __init__(self, spark: SparkSession, base: str, params: MeasureParams = DEFAULT_PARAMS, grain: str = "day"):
        if grain not in ("day", "month", "year"):
            raise ValueError(f"not a grain: {grain}")
        self.spark, self.base, self.params, self.grain = spark, base.rstrip("/"), params, grain
        none = spark.createDataFrame([], RAW_SCHEMA)
        staged = stage_visits(none, params, strict_dates=False).select(*STAGING_COLUMNS)
        fact = marts.fct_er_visit(staged, params)
        cells = wc.visit_cells(fact)
        batched = {"stg_er_visits": staged, "fct_er_visit": fact, "agg_visit_cells": cells,
                   "segment_members": staged.select("visit_date", *SEGMENT_COLUMNS)}
        self.schemas = {
            **{name: StructType([*df.schema.fields, StructField("batch", IntegerType())])
               for name, df in batched.items()},
            "agg_hourly_arrivals": marts.agg_hourly_arrivals(cells).schema,
            "daily_series": spc.daily_series(cells).schema,
        }

    def read(self, name: str, where: Column | None = None) -> DataFrame:
        """The table with its own columns; ``where``: a condition on its partitions."""
        schema = self.schemas[name]
        rows = self.spark.read.schema(StructType([*schema.fields, StructField("part", DateType())])).parquet(
            f"{self.base}/{name}")
        return (rows if where is None else rows.where(where)).select(*schema.names)

    def replace(self, name: str, rows: DataFrame, *more: str, spread: tuple[str, ...] = ()) -> None:
        """Overwrite the partitions that ``rows`` has rows of, of ``more`` columns too. ``spread``:
        columns that deal a crowded partition over several files, in ranges; where a partition holds
        many dates, a task's rows are worth files of their own and are sorted but not moved."""
        part = F.col("visit_date") if self.grain == "day" else F.trunc("visit_date", self.grain)
        rows = rows.withColumn("part", part)
        keys = ["part", *more]
        if not spread:
            rows = rows.repartition(*keys)
        elif self.grain == "day":
            rows = rows.repartitionByRange(*keys, *spread)
        else:
            rows = rows.sortWithinPartitions(*keys, *spread)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*keys).parquet(f"{self.base}/{name}"))


def _on(parts: list) -> Column:
    """The rows of ``parts``: a condition on the partition column alone, so other partitions'
    files are not opened."""
    known = [F.lit(d) for d in parts if d is not None]
    rows = F.col("part").isin(*known) if known else F.lit(False)
    return rows | F.col("part").isNull() if None in parts else rows


def refresh_batch(tables: DatedTables, raw: DataFrame, batch: int) -> list:
    """Take one batch of raw visits in; returns the partitions whose rows were replaced."""
    p, mine = tables.params, F.col("batch") == batch

    def add(name: str, rows: DataFrame, *spread: str) -> None:
        tables.replace(name, rows.withColumn("batch", F.lit(batch)), "batch", spread=spread)

    staged = stage_visits(raw.select(*RAW_COLUMNS), p, strict_dates=False).select(*STAGING_COLUMNS)
    add("stg_er_visits", staged, "visit_date", "visit_hour", "visit_id")
    own = tables.spark.read.schema("part date, batch int").parquet(f"{tables.base}/stg_er_visits")
    parts = [r[0] for r in own.where(mine).select("part").distinct().collect()]
    if not parts:
        return parts
    stg = tables.read("stg_er_visits", mine).select(*STAGING_COLUMNS)
    add("fct_er_visit", marts.fct_er_visit(stg, p), "visit_date", "visit_hour", "visit_id")
    add("segment_members", stg.select("visit_date", *SEGMENT_COLUMNS).distinct(), "visit_date", "segment_key")
    add("agg_visit_cells", wc.visit_cells(tables.read("fct_er_visit", mine)), "visit_date", "visit_hour",
        "segment_key", "department_referral", "wait_minutes")
    hours = wc.hour_counts(tables.read("agg_visit_cells", _on(parts)))
    tables.replace("agg_hourly_arrivals", marts.agg_hourly_arrivals(hours))
    tables.replace("daily_series", spc.daily_series(hours))
    return parts


def write_undated(tables: DatedTables) -> None:
    """The tables without a date of their own, whole, from the dated aggregates."""
    spark, p = tables.spark, tables.params
    cells, daily, hourly = (tables.read(n) for n in ("agg_visit_cells", "daily_series", "agg_hourly_arrivals"))
    segments = tables.read("segment_members").select(*SEGMENT_COLUMNS).distinct()
    arrivals = hourly.select(F.col("hour_of_day").alias("visit_hour"), F.col("arrivals").alias("visits"))
    sinks.write_marts({
        "agg_daily_ops": spc.chart_daily(daily, p),
        "agg_segment_waits": marts.agg_segment_waits(cells, segments, p),
        "dim_date": dims.dim_date(daily),
        "dim_time_of_day": dims.dim_time_of_day(spark, arrivals),
        "dim_patient_segment": segments,
        "dim_department": dims.dim_department(cells),
    }, tables.base)
    sinks.write_params(spark, p, tables.base)


def refreshed_warehouse(spark: SparkSession, base: str, params: MeasureParams | None = None) -> Warehouse:
    """The warehouse in a refreshed folder."""
    params = params or sinks.read_params(spark, base)
    tables = DatedTables(spark, base, params)
    undated = ["agg_daily_ops", "agg_segment_waits", "dim_date", "dim_time_of_day", "dim_patient_segment",
               "dim_department"]
    dated = {"fct_er_visit": tables.read("fct_er_visit").drop("batch"),
             "agg_hourly_arrivals": tables.read("agg_hourly_arrivals"),
             "agg_visit_cells": wc.merged_cells(tables.read("agg_visit_cells"))}
    return Warehouse(spark, sinks.read_marts(spark, base, undated) | dated,
                     stg_er_visits=tables.read("stg_er_visits").select(*STAGING_COLUMNS), params=params)


def refresh_landing(spark: SparkSession, landing_dir: str, base: str, checkpoint_location: str | None = None,
                    params: MeasureParams = DEFAULT_PARAMS, max_files_per_trigger: int | None = None,
                    grain: str = "day", after: Callable[[int, list], None] | None = None) -> StreamingQuery:
    """Start a stream that takes in the files that have landed since the last run, then ends
    (``awaitTermination`` it). ``after(batch, parts)`` is called behind every batch."""
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/landing-refresh"
    reader = spark.readStream.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    tables = DatedTables(spark, base, params, grain)

    def take(raw: DataFrame, batch: int) -> None:
        parts = refresh_batch(tables, raw, batch)
        if parts:
            write_undated(tables)
        if after:
            after(batch, parts)

    return (reader.csv(landing_dir).writeStream.foreachBatch(take).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
