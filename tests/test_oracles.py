"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import __spark_entry__
import oracle
import pytest
from tallyloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_lists_them():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_twin(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
