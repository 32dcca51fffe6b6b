"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

from .parity import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, FOLDER, name, con) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
