"""Every registered query equals its DuckDB oracle (rows, columns, values).

Runs at sf0.001 by default; set ``QUARRY_ORACLE_SF=/root/testdata/sf0.01`` for
the driver's scale.
"""

import os

import pytest

import __spark_entry__ as entry
from quarry.plans.catalog import QUERIES as OWN
from conftest import SF_SMALL
from oracle_compare import compare, duck

SF = os.environ.get("QUARRY_ORACLE_SF", SF_SMALL)
QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, QUERIES[name], SQL[name], SF)
    assert ok, f"{name}: {msg}"
