"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import pytest

from tests.conftest import SF
from wattlake.plans.oracles import ORACLES
from wattlake.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
if not os.path.exists(SF):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, tables, name):
    got = QUERIES[name](spark, SF)
    want = tables.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.columns, got.collect()) == table(want.columns, want.fetchall())


def test_every_query_has_its_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_the_contract_registers_them():
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
