"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tallymart.oracle import oracle
from tallymart.queries import registry
from tests.check_oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry()) == set(oracle())
    assert set(registry()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
