"""The driver contract: entry() runs, and every registered query matches its
DuckDB oracle (row count, column names, order-insensitive value hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline import catalog
from tests.conftest import SF001
from tools.compare import TABLES, digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["mart_key", "date_key", "transaction_type", "customer_segment",
                          "settled_amount", "transaction_count", "fraud_count"]
    assert df.count() == 149


def test_every_core_query_has_an_oracle():
    """With and without the optional training-data queries."""
    assert set(catalog.QUERIES) <= set(E.queries())
    assert not set(catalog.QUERIES) - set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
