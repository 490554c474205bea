"""M2-M5: dimensions.

All four are bounded by the calendar span, 24 hours, or the distinct values of low-
cardinality attributes; their inputs are reduced by partial aggregation before any
shuffle, so even a heavily skewed attribute value costs one pre-aggregated row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.functions.parsing import shift_band


def dim_date(stg: DataFrame) -> DataFrame:
    """M2: one row per calendar day from the first to the last visit date, gap-free.

    Day of week: 0 = Sunday ... 6 = Saturday; weekend = {0, 6}.
    """
    bounds = stg.agg(F.min("visit_date").alias("lo"), F.max("visit_date").alias("hi"))
    days = bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
    dow = (F.dayofweek("date_day") - 1).cast("int")
    return days.select(
        "date_day",
        F.year("date_day").cast("int").alias("year"),
        F.month("date_day").cast("int").alias("month"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        dow.alias("day_of_week_num"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def hourly_totals(stg: DataFrame) -> DataFrame:
    """Arrivals per hour of day over the whole window (<= 24 rows), from visits or their cells."""
    arrivals = F.sum("visits") if "visits" in stg.columns else F.count(F.lit(1))
    return stg.groupBy(F.col("visit_hour").alias("hour_of_day")).agg(arrivals.alias("arrivals"))


def dim_time_of_day(spark: SparkSession, stg: DataFrame, empty_hours_peak: bool = False) -> DataFrame:
    """M3: 24 hours with shift band and ``is_peak``.

    ``is_peak``: the hour's total arrivals are at or above the median of the hourly
    totals of hours that had arrivals. An hour with no arrivals is not a peak;
    ``empty_hours_peak=True`` reproduces the source system, where such an hour compares
    0 >= 0 and is marked as a peak.
    """
    totals = hourly_totals(stg)
    median = totals.agg(F.median("arrivals")).scalar()  # one scalar subquery
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour_of_day"))
    # totals has at most 24 rows (one per hour): a bounded broadcast.
    joined = hours.join(F.broadcast(totals), "hour_of_day", "left")
    return joined.select(
        "hour_of_day",
        shift_band(F.col("hour_of_day")).alias("shift"),
        (F.when(F.col("arrivals").isNull(), F.lit(empty_hours_peak))
         .otherwise(F.coalesce(F.col("arrivals") >= median, F.lit(False)))).alias("is_peak"),
    )


def dim_patient_segment(stg: DataFrame) -> DataFrame:
    """M4: observed (age_band, gender, race) combinations with their key."""
    return stg.select("segment_key", "age_band", "gender", "race").distinct()


def dim_department(stg: DataFrame) -> DataFrame:
    """M5: referral departments, the text 'None' included as a member."""
    return stg.select("department_referral").distinct()
