"""Distributed ranking: global row index and ``ntile`` without a single-partition window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task. Here the
rows are range-partitioned and sorted on a *total* order (ties broken by the extra
keys), each row gets its position inside its partition, and the per-partition row
counts (one small row per partition, a proven bound) are turned into start offsets.
A heavy value of the first sort key is spread over several range partitions because
the total order includes the tie-breakers, so no task holds a hot group whole.

The numbered frame is checkpointed (reliably, to ``spark.checkpoint.dir``) so that the
offsets and the rows they index come from one and the same materialization, also
after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careflow.session import checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def global_row_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "row_index",
                     total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based ``index_col`` following the total order ``order_cols``."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        df.repartitionByRange(n_parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    by_pid = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(by_pid), F.lit(0)).alias("_offset"),
        *([F.sum("_cnt").over(Window.partitionBy()).alias(total_col)] if total_col else []),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _LOCAL_BITS)
    # offsets has one row per range partition: broadcasting it is bounded.
    return (
        numbered.join(F.broadcast(offsets), "_pid")
        .withColumn(index_col, F.col("_offset") + local)
        .drop("_pid", "_mid", "_offset")
    )


def ntile(df: DataFrame, k: int, order_cols: Sequence[str], out_col: str = "ntile") -> DataFrame:
    """SQL ``ntile(k) over (order by order_cols)``: bucket sizes differ by at most one,
    the first ``N mod k`` buckets get the extra row."""
    ranked = global_row_index(df, order_cols, "_i", "_n")
    i, n = F.col("_i"), F.col("_n")
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    bucket = F.when(i < big, F.floor(i / (q + 1))).otherwise(r + F.floor((i - big) / q)) + 1
    return ranked.withColumn(out_col, bucket.cast("int")).drop("_i", "_n")


def global_cumsum(df: DataFrame, order_cols: Sequence[str], weight_col: str,
                  out_col: str = "cum_before", num_partitions: int | None = None) -> DataFrame:
    """Exclusive running sum of ``weight_col`` along the total order ``order_cols``.

    Range partitions are checkpointed with their partition id; the running sum inside a
    partition is a window over that partition's rows (a balanced range partition, never a
    key group), and partition offsets come from one small row per partition.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = (
        df.repartitionByRange(n_parts, *order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    totals = parts.groupBy("_pid").agg(F.sum(weight_col).alias("_w"))
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_w").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(weight_col).over(inside), F.lit(0))
    # offsets: one row per range partition, a bounded broadcast
    return (
        parts.withColumn("_local", local)
        .join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, F.col("_offset") + F.col("_local"))
        .drop("_pid", "_local", "_offset")
    )
