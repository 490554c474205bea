"""M6, M7, M9: the visit fact and the hourly and segment aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.operators import wait_counts as wc
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.schema import FACT_COLUMNS


def fct_er_visit(stg: DataFrame, params: MeasureParams = DEFAULT_PARAMS) -> DataFrame:
    """M6: one row per visit; personal attributes stay behind in staging."""
    within = (
        F.col("wait_minutes").isNotNull()
        & ~F.col("wait_implausible_flag")
        & (F.col("wait_minutes") <= F.lit(params.wait_target_minutes))
    )
    return stg.withColumn("within_target_flag", F.coalesce(within, F.lit(False))).select(*FACT_COLUMNS)


def agg_hourly_arrivals(rows: DataFrame) -> DataFrame:
    """M7: one row per (visit_date, hour) with arrivals and the plausible median wait, from the
    cells (or from visits).

    The median keeps a value->count map per group (partial aggregation on the map side),
    and waits are whole minutes, so the buffer is small even for a very hot hour.
    """
    return wc.as_cells(rows).groupBy("visit_date", F.col("visit_hour").alias("hour_of_day")).agg(
        F.sum("visits").alias("arrivals"),
        F.percentile(wc.plausible_wait(), 0.5, F.col("visits")).cast("double").alias("median_wait_minutes"),
    )


def segment_wait_stats(rows: DataFrame) -> DataFrame:
    """Per-segment wait statistics (before the dimension join) from the cells (or from visits):
    counts per segment and wait first, then moments and quantiles over those few rows."""
    keys = ["segment_key", "wait_minutes", "wait_implausible_flag"]
    counts = wc.as_cells(rows).groupBy(*keys).agg(F.sum("visits").alias("visits"))
    w = wc.plausible_wait()
    return counts.groupBy("segment_key").agg(
        F.sum("visits").alias("n_visits"),
        wc.total("visits", w.isNotNull()).alias("n_plausible"),
        wc.mean_wait().alias("mean_raw"),
        wc.sd_wait().alias("sd_raw"),
        F.percentile(w, 0.5, F.col("visits")).cast("double").alias("median_raw"),
        F.percentile(w, 0.9, F.col("visits")).cast("double").alias("p90_raw"),
    )


def agg_segment_waits(rows: DataFrame, dim_segment: DataFrame,
                      params: MeasureParams = DEFAULT_PARAMS) -> DataFrame:
    """M9: per segment n, median, P90, mean and a normal-theory 95% CI on the median,
    with small-cell suppression (estimates NULL below ``min_cell_size``; counts stay).

    The rows are aggregated by ``segment_key`` first (map-side partial aggregation),
    so the dimension join is between two per-segment tables: no fact-sized join, and
    no broadcast whose size depends on the data. Joining after aggregating gives the
    same rows as joining first, also when a key occurs twice in the dimension.
    """
    stats = segment_wait_stats(rows)
    joined = stats.join(dim_segment, "segment_key")
    ok = F.col("n_plausible") >= F.lit(params.min_cell_size)
    half = F.lit(params.ci_z) * (
        F.lit(params.median_se_factor) * F.col("sd_raw") / F.sqrt(F.col("n_plausible"))
    )
    return joined.select(
        "segment_key",
        "age_band",
        "gender",
        "race",
        F.col("n_visits").cast("bigint").alias("n_visits"),
        F.col("n_plausible").cast("bigint").alias("n_plausible"),
        F.when(ok, F.col("median_raw")).alias("median_wait_minutes"),
        F.when(ok, F.col("p90_raw")).alias("p90_wait_minutes"),
        F.when(ok, F.col("mean_raw")).alias("mean_wait_minutes"),
        F.when(ok, F.col("median_raw") - half).alias("ci_lower"),
        F.when(ok, F.col("median_raw") + half).alias("ci_upper"),
        (F.col("n_plausible") < F.lit(params.min_cell_size)).alias("low_n_flag"),
    )
