"""Every registered query against its SQL, on whole tables."""

import pytest
from parity import compare, connect

import __spark_entry__ as entry_module
from tablewire.plans.oracles import ORACLES
from tablewire.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, con, sf_dir):
    difference, _ = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    assert difference is None


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 8
    assert sum(r["record_count"] for r in rows) > 0
