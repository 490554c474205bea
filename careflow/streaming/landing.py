"""Landing folder -> staging table, exactly once per file (file source + checkpoint).

The streaming file source lists the folder, remembers processed files in the
checkpoint, and each trigger types only the new files with the same staging projection
as the batch build (lenient dates: a bad row gets a NULL timestamp instead of failing
the stream, and can be reported with ``operators.staging.unparseable_dates``). The
sink is a parquet folder; with ``availableNow`` the query processes what has landed
and stops, so it can run as a scheduled job that survives restarts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from careflow.operators.staging import stage_visits
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.plans.warehouse import Warehouse, build_warehouse
from careflow.schema import RAW_COLUMNS, RAW_SCHEMA
from careflow.session import checkpoint_dir


def ingest_landing(spark: SparkSession, landing_dir: str, staging_dir: str,
                   checkpoint_location: str | None = None, params: MeasureParams = DEFAULT_PARAMS,
                   available_now: bool = True, max_files_per_trigger: int | None = None,
                   archive_dir: str | None = None) -> StreamingQuery:
    """Start the ingest stream; returns the running query (``awaitTermination`` it).

    ``archive_dir``: move each file there once it is committed, so the landing folder
    (and its listing on every trigger) does not grow without bound.
    """
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/landing-ingest"
    reader = spark.readStream.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    raw = reader.csv(landing_dir).select(*RAW_COLUMNS)
    staged = stage_visits(raw, params, strict_dates=False)
    writer = (staged.writeStream.format("parquet").option("checkpointLocation", ckpt)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(staging_dir)


def rebuild_from_staging(spark: SparkSession, staging_dir: str,
                         params: MeasureParams = DEFAULT_PARAMS) -> Warehouse:
    """The marts over everything ingested so far (a full, idempotent rebuild)."""
    stg = spark.read.parquet(staging_dir)
    return build_warehouse(spark, raw=None, params=params, stg=stg)
