from __future__ import annotations

from careflow.__main__ import main

from conftest import DATA


def test_cli_build_check_export_metric(spark, tmp_path, capsys):
    wh = str(tmp_path / "wh")
    assert main(["build", "--raw", str(DATA / "edge_visits.csv"), "--out", wh]) == 0
    assert main(["check", "--warehouse", wh]) == 1   # the edge file fails 9 tests on purpose
    assert main(["export", "--warehouse", wh, "--out", str(tmp_path / "csv")]) == 0
    assert main(["metric", "--warehouse", wh, "kpi_summary"]) == 0
    assert main(["profile", "--raw", str(DATA / "edge_visits.csv"), "--out", str(tmp_path / "prof")]) == 0
    assert spark.read.parquet(str(tmp_path / "prof" / "columns")).count() == 12
