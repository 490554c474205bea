"""Every registered query against its DuckDB SQL on the sf0.001 driver tables
(the driver runs the same comparison at sf0.01; ``python tests/harness.py`` runs it)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from harness import compare, duck

from careflow.plans import catalog
from conftest import SF0001

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF0001, con)
    assert ok, msg


def test_every_query_has_oracle_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["visit_date", "visits", "admissions"]
    assert df.count() > 0
