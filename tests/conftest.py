from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

DATA = ROOT / "tests" / "data"
SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from careflow.session import local_session

    cores = min(8, os.cpu_count() or 2)
    s = local_session(cores=cores, shuffle_partitions=8, app_name="careflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def edge_raw(spark):
    from careflow.sources.raw_csv import read_raw_visits

    return read_raw_visits(spark, str(DATA / "edge_visits.csv"))


@pytest.fixture(scope="session")
def edge_wh(spark, edge_raw):
    from careflow.plans.warehouse import build_warehouse

    return build_warehouse(spark, edge_raw)
