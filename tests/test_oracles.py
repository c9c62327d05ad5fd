"""Every registered query against its SQL twin, all rows and types."""

import os

import compare
import pytest

import __spark_entry__ as entry
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    got = compare.spark_rows(entry.queries()[name](spark, SF))
    want = compare.duck_rows(con, entry.oracle_sql()[name])
    assert compare.difference(got, want) is None


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
