"""Every registered query with an oracle equals it on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from ledgerline.llm.queries import ORACLE, QUERIES
from tests.conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = QUERIES[name](spark, SF001)
    own = duckdb.connect()
    for table in ("documents", "labels"):
        own.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF001}/{table}.parquet'")
    want = own.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    columns = sorted(names)
    assert sorted(got.columns) == columns
    b = [[r[names.index(c)] for c in columns] for r in want.fetchall()]
    a = [[r[c] for c in columns] for r in got.collect()]
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
