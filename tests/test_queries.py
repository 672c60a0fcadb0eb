"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import os

import pytest

from checks.catalog import queries
from checks.compare import compare, connect
from checks.oracles import oracle_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, FOLDER, name) == ""


def test_entry(spark):
    import __spark_entry__ as contract

    frame = contract.entry(spark)
    assert frame.columns == ["client_id", "segment_type_id"] and frame.count() > 0
