"""Schemas: the raw visit file and the column lists of staging and the marts."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Raw column names in file order, and the header text the source file
# carries for them (the header is checked, the data is renamed by position).
RAW_COLUMNS = [
    "patient_id",
    "admission_date_raw",
    "first_initial",
    "last_name",
    "gender_raw",
    "age_raw",
    "race_raw",
    "department_referral_raw",
    "admitted_flag_raw",
    "satisfaction_score_raw",
    "wait_minutes_raw",
    "case_management_flag_raw",
]
RAW_HEADER = [
    "Patient Id",
    "Patient Admission Date",
    "Patient First Inital",
    "Patient Last Name",
    "Patient Gender",
    "Patient Age",
    "Patient Race",
    "Department Referral",
    "Patient Admission Flag",
    "Patient Satisfaction Score",
    "Patient Waittime",
    "Patients CM",
]

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

STAGING_COLUMNS = [
    "visit_id", "visit_ts", "visit_date", "visit_hour", "first_initial", "last_name",
    "gender", "age", "age_band", "race", "department_referral", "admitted_flag",
    "satisfaction_score", "wait_minutes", "wait_implausible_flag", "case_management_flag",
    "segment_key",
]

# Personal data lives in staging only; marts and exports never carry these.
PERSONAL_COLUMNS = ["first_initial", "last_name", "age", "gender", "race"]

FACT_COLUMNS = [
    "visit_id", "visit_ts", "visit_date", "visit_hour", "segment_key", "department_referral",
    "wait_minutes", "wait_implausible_flag", "within_target_flag", "admitted_flag",
    "satisfaction_score", "case_management_flag",
]

MART_TABLES = [
    "fct_er_visit",
    "agg_daily_ops",
    "agg_hourly_arrivals",
    "agg_segment_waits",
    "dim_date",
    "dim_time_of_day",
    "dim_patient_segment",
    "dim_department",
]

# Visits counted per wait: read by marts and metrics, not exported.
COUNTED_TABLES = ["agg_visit_cells", "agg_wait_counts"]
