"""The one-pass tests of a table against the single checks."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.operators.quality import Check
from ledgerline.plans import registry

KEYS = ("check", "table_name", "column_name", "failures", "status")


def rows_of(df):
    return sorted(tuple(r[k] for k in KEYS) for r in df.collect())


def single(df, checks, table):
    out = []
    for c in checks:
        if c.kind == "unique":
            out.append(quality.unique(df, c.column, table))
        elif c.kind == "not_null":
            out.append(quality.not_null(df, [c.column], table))
        elif c.kind == "accepted_values":
            out.append(quality.accepted_values(df, c.column, c.values, table))
        else:
            out.append(quality.relationships(df, c.column, c.parent[0], c.parent[1], table, c.parent[2]))
    return quality.union_checks(out)


def checks_of(dims, days):
    return [Check("unique", "id"), Check("unique", "a"), Check("not_null", "id"), Check("not_null", "a"), Check("not_null", "day"),
            Check("accepted_values", "kind", ("x", "y")), Check("accepted_values", "flag", (True,)), Check("accepted_values", "id", (1, 2)),
            Check("relationships", "a", parent=(dims, "k", "dim")), Check("relationships", "b", parent=(dims, "k", "dim")),
            Check("relationships", "day", parent=(days, "day", "days"))]


SCHEMA = "id int, a string, b string, kind string, flag boolean, day date"


def sample(spark, n, seed):
    rng = random.Random(seed)

    def some(values):
        return rng.choice([*values, None])
    data = [(some(range(n)), some("pqr"), "hot" if i % 3 else some("pq"), some("xyz"), some([True, False]),
             __import__("datetime").date(2023, 1, rng.randrange(1, 9)) if rng.random() < .9 else None) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def test_equal_to_the_single_checks(spark):
    dims = spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "k string")
    days = spark.sql("SELECT explode(sequence(DATE'2023-01-01', DATE'2023-01-06')) AS day")
    for n, seed in ((0, 1), (1, 2), (40, 3), (900, 4)):
        df = sample(spark, n, seed)
        checks = checks_of(dims, days)
        assert rows_of(quality.table_checks(df, checks, "t")) == rows_of(single(df, checks, "t"))


def test_empty_parent_and_no_checks(spark):
    df = sample(spark, 30, 5)
    none = spark.createDataFrame([], "k string")
    checks = [Check("relationships", "a", parent=(none, "k", "dim"))]
    assert rows_of(quality.table_checks(df, checks, "t")) == rows_of(single(df, checks, "t"))
    assert quality.table_checks(df, [], "t").count() == 0


def test_the_fact_is_scanned_once_for_its_twelve_checks(spark, tmp):
    from ledgerline import catalog
    from tests.conftest import SF001
    tables = catalog._tables(spark, SF001)  # noqa: SLF001
    stored = {}
    for name, df in tables.items():
        path = f"{tmp}/{name}"
        df.write.parquet(path)
        stored[name] = spark.read.schema(df.schema).parquet(path)
    model = next(m for m in registry.MODELS if m.qualified == "gold.fact_transaction")
    frames = registry.model_checks(model, stored[model.qualified], stored)
    assert len(frames) == 1
    got = rows_of(frames[0])
    assert len(got) == 12 and {r[4] for r in got} == {"pass"}
    plan = frames[0]._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert [("Relation" in line) for line in plan.splitlines() if "Relation" in line and "transaction_id" in line] == [True]
    assert "Join" not in plan and plan.count("Aggregate [") == 2
    broken = stored[model.qualified].withColumn("orig_account_key", F.lit("nobody"))
    bad = [r for r in rows_of(registry.model_checks(model, broken, stored)[0]) if r[4] == "fail"]
    assert [(r[0], r[2], r[3]) for r in bad] == [("relationships", "orig_account_key->gold.dim_account.account_key", broken.count())]
