"""M1: raw visit rows -> typed staging rows (one output row per input row).

A single narrow projection: no shuffle, fully inside whole-stage codegen. Quality
flags are computed and carried, never used to drop rows, so visit counts always
reconcile with the raw input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.functions.parsing import (
    age_band,
    parse_bool_text,
    parse_double,
    parse_int_rounding,
    parse_visit_ts,
    segment_key,
)
from careflow.params import DEFAULT_PARAMS, MeasureParams
from careflow.schema import STAGING_COLUMNS


def stage_visits(raw: DataFrame, params: MeasureParams = DEFAULT_PARAMS,
                 strict_dates: bool = True) -> DataFrame:
    c = F.col
    parsed = raw.select(
        c("patient_id").alias("visit_id"),
        parse_visit_ts(c("admission_date_raw"), strict=strict_dates).alias("visit_ts"),
        c("first_initial"),
        c("last_name"),
        F.trim(c("gender_raw")).alias("gender"),
        parse_int_rounding(c("age_raw")).alias("age"),
        F.trim(c("race_raw")).alias("race"),
        F.trim(c("department_referral_raw")).alias("department_referral"),
        parse_bool_text(c("admitted_flag_raw")).alias("admitted_flag"),
        parse_double(c("satisfaction_score_raw")).alias("satisfaction_score"),
        parse_int_rounding(c("wait_minutes_raw")).alias("wait_minutes"),
        (c("case_management_flag_raw") == F.lit("1")).alias("case_management_flag"),
    )
    band = age_band(c("age"))
    staged = parsed.withColumns({
        "visit_date": F.to_date(c("visit_ts")),
        "visit_hour": F.hour(c("visit_ts")).cast("int"),
        "age_band": band,
        "wait_implausible_flag": c("wait_minutes") > F.lit(params.max_plausible_wait_minutes),
    }).withColumn("segment_key", segment_key(c("age_band"), c("gender"), c("race")))
    return staged.select(*STAGING_COLUMNS)


def unparseable_dates(raw: DataFrame) -> DataFrame:
    """Lenient-mode companion: raw rows whose non-null date text does not parse."""
    ts = parse_visit_ts(F.col("admission_date_raw"), strict=False)
    return raw.filter(F.col("admission_date_raw").isNotNull() & ts.isNull())
