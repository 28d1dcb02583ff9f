"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle_check import compare, duck
from tessera.plans import catalog

# the training-data queries have their own tests in tests/llm
QUERIES = {k: q for k, q in entry.queries().items() if k in catalog.queries()}
ORACLES = {k: q for k, q in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SMALL, name, QUERIES[name], ORACLES.get(name), con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["query_id", "rank", "id", "similarity"]
    assert len(rows) > 0


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = {"s11_synthetic_vectors"}
    missing = set(QUERIES) - set(ORACLES) - rows_only
    assert not missing, missing
