"""Edge rows of the raw file: typing, banding, flags, keys."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from careflow.operators import staging
from careflow.schema import PERSONAL_COLUMNS
from careflow.sources.raw_csv import RawHeaderError, read_raw_visits


def rows_by_id(df):
    return {r["visit_id"]: r for r in df.collect() if r["visit_id"] not in ("P11", "P12")}


def test_raw_reader_keeps_text_none_and_blank_as_null(edge_raw):
    r = {x["patient_id"]: x for x in edge_raw.collect()}
    assert r["P01"]["department_referral_raw"] == "None"
    assert r["P02"]["department_referral_raw"] is None
    assert len(edge_raw.columns) == 12
    assert edge_raw.count() == 14


def test_header_check(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(RawHeaderError):
        read_raw_visits(spark, str(bad))


def test_typing(edge_wh):
    r = rows_by_id(edge_wh.stg_er_visits)
    assert r["P01"]["visit_ts"] == dt.datetime(2024, 3, 1, 8, 47)
    assert r["P02"]["visit_ts"] == dt.datetime(2024, 3, 1, 8, 47)
    assert r["P01"]["visit_date"] == dt.date(2024, 3, 1) and r["P01"]["visit_hour"] == 8
    assert r["P03"]["gender"] == "M"
    assert r["P07"]["wait_minutes"] == 13          # '12.6' rounds
    assert r["P08"]["wait_minutes"] is None        # junk
    assert r["P06"]["wait_minutes"] == -3
    assert r["P03"]["admitted_flag"] is True       # ' true'
    assert r["P05"]["admitted_flag"] is None       # blank
    assert r["P02"]["case_management_flag"] is True
    assert r["P06"]["case_management_flag"] is False  # ' 1' is not '1'
    assert r["P04"]["satisfaction_score"] == 11.0


def test_age_bands(edge_wh):
    r = rows_by_id(edge_wh.stg_er_visits)
    expect = {"P01": "0-17", "P02": "18-34", "P03": "18-34", "P04": "35-49", "P05": "35-49",
              "P07": "50-64", "P08": "50-64", "P09": "65+", "P10": None}
    assert {k: r[k]["age_band"] for k in expect} == expect


def test_flags(edge_wh):
    r = {x["visit_id"]: x for x in edge_wh.fct_er_visit.collect() if x["visit_id"] not in ("P11", "P12")}
    assert r["P03"]["wait_implausible_flag"] is False and r["P03"]["within_target_flag"] is False
    assert r["P04"]["wait_implausible_flag"] is True and r["P04"]["within_target_flag"] is False
    assert r["P05"]["wait_implausible_flag"] is None and r["P05"]["within_target_flag"] is False
    assert r["P01"]["within_target_flag"] is True and r["P02"]["within_target_flag"] is False


def test_segment_key_md5_and_collision(edge_wh):
    r = rows_by_id(edge_wh.stg_er_visits)
    expected = hashlib.md5(b"35-49|unknown|White").hexdigest()
    assert r["P05"]["segment_key"] == expected == r["P06"]["segment_key"]
    assert r["P10"]["segment_key"] == hashlib.md5(b"unknown|M|White").hexdigest()
    dim = edge_wh.dim_patient_segment.filter(F.col("segment_key") == expected).count()
    assert dim == 2  # NULL gender and the text 'unknown' collide


def test_personal_data_stays_in_staging(edge_wh):
    # names never leave staging; the visit fact carries no individual demographics
    for name, df in edge_wh.marts().items():
        assert not {"first_initial", "last_name", "age"} & set(df.columns), name
    assert not set(PERSONAL_COLUMNS) & set(edge_wh.fct_er_visit.columns)


def test_row_counts_reconcile(edge_raw, edge_wh):
    assert edge_raw.count() == edge_wh.stg_er_visits.count() == edge_wh.fct_er_visit.count() == 14


def test_strict_dates_raise_and_lenient_counts(spark, tmp_path):
    from careflow.schema import RAW_HEADER

    f = tmp_path / "bad_date.csv"
    f.write_text(",".join(RAW_HEADER) + "\nQ1,31-02-2024 25:00,A,B,M,3,White,None,TRUE,,10,0\n"
                 "Q2,01-03-2024 08:00,A,B,M,3,White,None,TRUE,,10,0\n")
    raw = read_raw_visits(spark, str(f))
    with pytest.raises(Exception):
        staging.stage_visits(raw).collect()
    lenient = staging.stage_visits(raw, strict_dates=False)
    assert lenient.filter(F.col("visit_ts").isNull()).count() == 1
    assert staging.unparseable_dates(raw).count() == 1


def test_header_with_bom(spark, tmp_path):
    from careflow.schema import RAW_HEADER

    f = tmp_path / "bom.csv"
    f.write_bytes(("\ufeff" + ",".join(RAW_HEADER) + "\nQ1,01-03-2024 08:00,A,B,M,3,White,None,TRUE,,10,0\n")
                  .encode("utf-8"))
    assert read_raw_visits(spark, str(f)).count() == 1
