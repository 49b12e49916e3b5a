"""Every query of the catalog against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from check_oracle import compare

import __spark_entry__ as contract
from tidemark.catalog import BATCH_QUERIES
from tidemark.stream_catalog import STREAM_QUERIES

SF_DIR = contract.SMOKE_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.mark.parametrize("name", [*BATCH_QUERIES, *STREAM_QUERIES])
def test_query_equals_its_sql(spark, name):
    count, problem = compare(spark, SF_DIR, contract.queries()[name], contract.oracle_sql()[name])
    assert not problem
    assert count > 0


def test_every_query_has_sql():
    assert {*BATCH_QUERIES, *STREAM_QUERIES} <= contract.oracle_sql().keys() <= contract.queries().keys()
