"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as contract
from skyledger.plans import ORACLE, QUERIES
from skyledger.plans.check import compare, duckdb_connection

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_contract_surface(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.columns == ["service_description", "total_cost"]
    assert df.count() > 0


def test_rows_only_queries_are_catalog_output():
    assert set(QUERIES) - set(ORACLE) == {"describe_table", "schema_fields"}
