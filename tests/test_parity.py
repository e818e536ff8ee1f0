"""Every registered query against its SQL, on whole tables."""

import pytest
from parity import connect, differences

import __spark_entry__ as entry_module
from orderlens.catalog.oracles import ORACLES
from orderlens.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(request):
    from conftest import SF_DIR

    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
