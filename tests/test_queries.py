"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF)


def test_every_ledger_query_has_sql():
    from crosstally.workloads import files
    from crosstally.workloads.oracle import ORACLE
    from crosstally.workloads.queries import QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(files.QUERIES) == set(files.ORACLE)


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(queries()[name](spark, SF), connection, oracle_sql()[name]) is None


def test_flagship(spark):
    causes = {r["cause"] for r in entry(spark).collect()}
    assert len(causes) == 12
