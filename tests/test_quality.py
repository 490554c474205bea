"""The 34 data tests: all pass on the clean driver mapping, the expected ones fail on
the edge file, and the failing-row frames agree with the summary counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from careflow.operators import quality
from careflow.plans.catalog import warehouse

from conftest import SF001


def _summary(wh):
    return {r["check_id"]: r["failures"] for r in quality.run_checks(wh).collect()}


def test_34_checks_defined():
    assert len(quality.CHECKS) == 34
    kinds = [c.test for c in quality.CHECKS]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("accepted_values"),
            kinds.count("relationships")) == (8, 18, 2, 6)


def test_all_pass_on_driver_mapping(spark):
    s = _summary(warehouse(spark, SF001))
    assert len(s) == 34 and all(v == 0 for v in s.values()), {k: v for k, v in s.items() if v}


def test_expected_failures_on_edge_file(edge_wh):
    s = _summary(edge_wh)
    failing = {k: v for k, v in s.items() if v}
    assert failing == {
        "stg_visit_id_unique": 2,            # P11, P12
        "fct_visit_id_unique": 2,
        "stg_wait_minutes_not_null": 4,      # blank x3 + 'abc'
        "stg_gender_accepted": 2,            # 'X', 'unknown'
        "dim_patient_segment_unique": 1,     # NULL gender vs text 'unknown'
        "segment_waits_unique": 1,           # ... which fans out the segment join
        "dim_department_not_null": 1,        # blank department
        "fct_department_not_null": 1,
        "fct_admitted_not_null": 1,
    }, failing


def test_failure_frames_agree(edge_wh):
    f = edge_wh.fct_er_visit
    assert quality.unique_failures(f, "visit_id").count() == 2
    assert quality.not_null_failures(f, "admitted_flag").count() == 1
    stg = edge_wh.stg_er_visits
    assert {r["gender"] for r in quality.accepted_values_failures(stg, "gender", ("M", "F", "NC")).collect()} \
        == {"X", "unknown"}


def test_relationship_check_catches_orphans(edge_wh):
    broken = edge_wh.dim_date.filter(F.col("date_day") != F.lit("2024-03-01").cast("date"))
    orphans = quality.relationship_failures(edge_wh.fct_er_visit, "visit_date", broken, "date_day")
    assert orphans.count() == 4


def test_reconciliation(edge_wh):
    r = quality.reconciliation(edge_wh).first()
    assert (r["raw_rows"], r["staging_rows"], r["fact_rows"], r["reconciled"]) == (14, 14, 14, True)
