"""Incremental refresh: late files, replayed batches and a full rebuild give the same tables, and
the dates that a batch does not touch keep their files."""

from __future__ import annotations

import shutil

import pytest

from conftest import DATA

from careflow.plans.warehouse import build_warehouse
from careflow.schema import MART_TABLES, RAW_HEADER
from careflow.sources.raw_csv import read_raw_visits
from careflow.streaming.refresh import DatedTables, refresh_batch, refresh_landing, refreshed_warehouse, write_undated

ROWS = {
    "b.csv": ["Q1,05-03-2024 08:00,A,B,F,30,Asian,Cardiology,TRUE,7,25,0",
              "Q2,05-03-2024 09:00,A,B,M,70,White,None,FALSE,,300,1",
              "Q3,not a date,A,B,NC,5,White,,TRUE,3,,0"],
    "late.csv": ["Q4,01-03-2024 23:59,A,B,F,30,Asian,Cardiology,TRUE,,45,0",  # a date of the first file
                 "Q5,20-02-2024 00:00,A,B,,,,,,,12,"],  # before the calendar's first day
}


def land(folder, name):
    if name == "a.csv":
        shutil.copy(DATA / "edge_visits.csv", folder / name)
    else:
        (folder / name).write_text("\n".join([",".join(RAW_HEADER), *ROWS[name]]) + "\n")


def contents(wh):
    return {t: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in wh.table(t).collect()),
                      key=repr) for t in MART_TABLES}


def files(base, table):
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in (base / table).rglob("part-*")}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Three runs of the stream, one file each, and what each batch touched."""
    root = tmp_path_factory.mktemp("refresh")
    landing, base = root / "landing", root / "wh"
    landing.mkdir()
    seen, snapshots = [], []
    for name in ("a.csv", "b.csv", "late.csv"):
        land(landing, name)
        refresh_landing(spark, str(landing), str(base), str(root / "ckpt"),
                        after=lambda batch, dates: seen.append((batch, dates))).awaitTermination()
        snapshots.append({t: files(base, t) for t in ("fct_er_visit", "agg_visit_cells", "agg_hourly_arrivals")})
    return landing, base, seen, snapshots


def test_late_files_give_the_tables_of_a_full_rebuild(spark, landed):
    landing, base, seen, _ = landed
    assert [batch for batch, _ in seen] == [0, 1, 2]
    full = build_warehouse(spark, read_raw_visits(spark, str(landing)), strict_dates=False)
    assert contents(refreshed_warehouse(spark, str(base))) == contents(full)


def test_only_touched_dates_are_rewritten(landed):
    _, _, seen, snapshots = landed
    dates = {f"part={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in seen[2][1]}
    assert dates == {"part=2024-03-01", "part=2024-02-20"}
    for table, after in snapshots[2].items():
        before = snapshots[1][table]
        kept = {p: t for p, t in before.items() if p.split("/")[1] not in dates}
        assert kept and all(after[p] == t for p, t in kept.items())
        assert all(p.split("/")[1] in dates for p in set(after) - set(before))


def test_a_replayed_batch_changes_nothing(spark, landed, tmp_path):
    landing, base, seen, _ = landed
    copy = tmp_path / "wh"
    shutil.copytree(base, copy)
    before = contents(refreshed_warehouse(spark, str(copy)))
    tables = DatedTables(spark, str(copy))
    for name, batch in (("b.csv", 1), ("late.csv", 2), ("b.csv", 1)):
        refresh_batch(tables, read_raw_visits(spark, str(landing / name)), batch)
    write_undated(tables)
    assert contents(refreshed_warehouse(spark, str(copy))) == before
    assert tables.read("stg_er_visits").count() == 14 + 3 + 2


def test_a_batch_that_failed_half_way_is_completed_by_its_replay(spark, landed, tmp_path, monkeypatch):
    landing, _, _, _ = landed
    tables = DatedTables(spark, str(tmp_path / "wh"))
    refresh_batch(tables, read_raw_visits(spark, str(landing / "a.csv")), 0)
    whole = tables.replace

    def breaks(name, *args, **kwargs):
        if name == "agg_visit_cells":
            raise RuntimeError("lost")
        whole(name, *args, **kwargs)

    monkeypatch.setattr(tables, "replace", breaks)
    with pytest.raises(RuntimeError):
        refresh_batch(tables, read_raw_visits(spark, str(landing / "late.csv")), 1)
    monkeypatch.undo()
    refresh_batch(tables, read_raw_visits(spark, str(landing / "late.csv")), 1)
    refresh_batch(tables, read_raw_visits(spark, str(landing / "b.csv")), 2)
    write_undated(tables)
    full = build_warehouse(spark, read_raw_visits(spark, str(landing)), strict_dates=False)
    assert contents(refreshed_warehouse(spark, str(tmp_path / "wh"))) == contents(full)


def test_months_as_partitions(spark, landed, tmp_path):
    landing = landed[0]
    tables = DatedTables(spark, str(tmp_path / "wh"), grain="month")
    assert len(refresh_batch(tables, read_raw_visits(spark, str(landing / "a.csv")), 0)) == 1
    refresh_batch(tables, read_raw_visits(spark, str(landing / "b.csv")), 1)
    assert {str(d) for d in refresh_batch(tables, read_raw_visits(spark, str(landing / "late.csv")), 2)} == {
        "2024-02-01", "2024-03-01"}
    write_undated(tables)
    full = build_warehouse(spark, read_raw_visits(spark, str(landing)), strict_dates=False)
    assert contents(refreshed_warehouse(spark, str(tmp_path / "wh"))) == contents(full)


def test_an_empty_batch_writes_nothing(spark, tmp_path):
    tables = DatedTables(spark, str(tmp_path / "wh"))
    none = read_raw_visits(spark, str(DATA / "edge_visits.csv")).limit(0)
    assert refresh_batch(tables, none, 0) == []
