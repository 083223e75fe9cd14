"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_points
from supplyprep.catalog import oracle_sql, queries

check_oracle = pytest.importorskip("check_oracle")


@pytest.fixture(scope="module")
def connection(data):
    return check_oracle.connect(data)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, connection, data, name):
    fine, note = check_oracle.compare(spark, connection, name, data)
    assert fine, note


def test_entry_has_rows(spark, data):
    assert entry_points.entry(spark).count() > 0


def test_sql_has_no_unknown_names():
    assert set(oracle_sql()) <= set(queries())
