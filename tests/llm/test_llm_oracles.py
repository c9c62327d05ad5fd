"""The operators that SQL can express, against their SQL twins on the generated tables."""

import os

import compare
import pytest

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    got = compare.spark_rows(QUERIES[name](spark, SF))
    want = compare.duck_rows(compare.duck(SF), ORACLES[name])
    assert compare.difference(got, want) is None
