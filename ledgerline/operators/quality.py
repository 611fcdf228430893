"""Data-quality checks returning one uniform frame:
``check, table_name, column_name, failures BIGINT, status``.

Semantics follow the usual data-test conventions:
* ``unique``: number of non-NULL values occurring more than once;
* ``not_null``: number of NULL rows (one aggregate pass for many columns);
* ``accepted_values``: number of *distinct* values outside the set; NULL passes;
* ``relationships``: child rows with a non-NULL key and no parent;
* ``freshness``: age of ``max(loaded_at)`` against warn / error thresholds.
Every check is an aggregate; nothing is collected except where a caller asks
for a verdict (``assert_checks``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import as_ntz

CHECK_SCHEMA = "check string, table_name string, column_name string, failures bigint, status string"


def _status(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def _row(df: DataFrame, check: str, table: str, column: str, failures: Column) -> DataFrame:
    f = F.coalesce(failures.cast("bigint"), F.lit(0).cast("bigint"))
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table_name"),
                     F.lit(column).alias("column_name"), f.alias("failures"),
                     _status(f).alias("status"))


def unique(df: DataFrame, column: str, table: str) -> DataFrame:
    dup = (df.select(column).filter(F.col(column).isNotNull()).groupBy(column)
           .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    return _row(dup.agg(F.count(F.lit(1)).alias("x")), "unique", table, column, F.col("x"))


def not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """All columns in one aggregate pass, then unpivoted to one row each."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    # an array of the counts, not a union: a union would scan once per column
    rows = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"n{i}").alias("n"))
                                             for i, c in enumerate(columns)])).alias("x"))
    return rows.select(F.lit("not_null").alias("check"), F.lit(table).alias("table_name"),
                       F.col("x.c").alias("column_name"), F.col("x.n").cast("bigint").alias("failures"),
                       _status(F.col("x.n")).alias("status"))


def accepted_values(df: DataFrame, column: str, values: Iterable, table: str) -> DataFrame:
    values = list(values)
    bad = (df.select(column).filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
           .distinct())
    return _row(bad.agg(F.count(F.lit(1)).alias("x")), "accepted_values", table, column, F.col("x"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  table: str, parent_table: str) -> DataFrame:
    """Orphan child rows (non-NULL key, no parent).

    Both sides are aggregated by key before they meet: the child side counts
    rows per key (partial aggregation, so a key holding a third of the child
    collapses map-side), the parent side is de-duplicated, and the two
    aggregates are already hash-partitioned on the join key, so the anti join
    adds no shuffle.
    """
    child_keys = (child.select(F.col(column).alias("_ck")).filter(F.col("_ck").isNotNull())
                  .groupBy("_ck").agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(parent_column).alias("_pk")).distinct()
    orphans = child_keys.join(keys, F.col("_ck") == F.col("_pk"), "left_anti")
    return _row(orphans.agg(F.sum("_n").alias("x")), "relationships",
                table, f"{column}->{parent_table}.{parent_column}", F.col("x"))


@dataclass(frozen=True)
class Check:
    """One test of a table, for ``table_checks``.  ``parents`` are the sides of
    a relationship: the parent's frame, its column and its table's name."""
    kind: str  # unique | not_null | accepted_values | relationships
    column: str
    values: tuple = ()
    parent: tuple | None = None

    @property
    def label(self) -> str:
        return f"{self.column}->{self.parent[2]}.{self.parent[1]}" if self.kind == "relationships" else self.column


def table_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """All tests of one table in one scan of it and one shuffle.

    Each row is unpivoted into (number of the test, key as text) pairs: its
    value for ``unique``, ``accepted_values`` and ``relationships``, and a pair
    without a key where a ``not_null`` column is NULL.  The pairs are counted
    before they move, so a key that holds a third of the rows is one row a
    task.  What a key may be (the accepted values, the distinct keys of the
    parents, each parent column read once for all tests that refer to it) joins
    the same aggregation, marked as allowed.  Then each test is a sum over its
    keys.  The results equal those of the single checks above.
    """
    checks = list(checks)
    if not checks:
        return df.sparkSession.createDataFrame([], CHECK_SCHEMA)
    pairs = []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        mine = col.isNull() if c.kind == "not_null" else col.isNotNull()
        pairs.append(F.when(mine, F.struct(F.lit(i).alias("i"), F.when(
            F.lit(c.kind != "not_null"), col.cast("string")).alias("k"))))
    rows = df.select(F.explode(F.array_compact(F.array(*pairs))).alias("x")).select(
        "x.i", "x.k", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("allowed"))

    allowed = [_allowed(df, checks)]
    for column, parent in {(c.parent[2], c.parent[1]): c.parent for c in checks if c.parent}.items():
        numbers = [i for i, c in enumerate(checks) if c.parent and (c.parent[2], c.parent[1]) == column]
        key = F.col(parent[1])
        allowed.append(parent[0].filter(key.isNotNull()).select(
            F.explode(F.array(*[F.lit(i) for i in numbers])).alias("i"), key.cast("string").alias("k")))
    every = reduce(DataFrame.unionByName, [rows] + [a.select(
        "i", "k", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("allowed")) for a in allowed])
    keys = every.groupBy("i", "k").agg(F.sum("n").alias("n"), F.max("allowed").alias("allowed"))
    kinds = F.element_at(F.array(*[F.lit(c.kind) for c in checks]), F.col("i") + 1)
    bad = (F.when(kinds == "unique", (F.col("n") > 1).cast("bigint"))
           .when(kinds == "not_null", F.col("n"))
           .when(~F.col("allowed"), F.when(kinds == "relationships", F.col("n")).otherwise(1)))
    failures = keys.groupBy("i").agg(F.coalesce(F.sum(bad), F.lit(0)).alias("failures"))
    names = F.element_at(F.array(*[F.lit(c.label) for c in checks]), F.col("i") + 1)
    return failures.select(kinds.alias("check"), F.lit(table).alias("table_name"), names.alias("column_name"),
                           "failures", _status(F.col("failures")).alias("status"))


def _allowed(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(test, key) of the accepted values, as text like the column's own; and
    one row without a key for every test, so that each has a result."""
    spark = df.sparkSession
    out = [(i, None, "string") for i in range(len(checks))]
    for i, c in enumerate(checks):
        out += [(i, v, df.schema[c.column].dataType.simpleString()) for v in c.values]
    literals = [F.struct(F.lit(i).alias("i"), F.lit(v).cast(t).cast("string").alias("k")) for i, v, t in out]
    return spark.range(1).select(F.explode(F.array(*literals)).alias("x")).select("x.*")


def expression(df: DataFrame, predicate: Column, check: str, table: str, column: str) -> DataFrame:
    """Rows violating ``predicate`` (NULL counts as a violation)."""
    return _row(df.agg(F.count_if(~F.coalesce(predicate, F.lit(False))).alias("x")),
                check, table, column, F.col("x"))


def freshness(df: DataFrame, column: str, as_of, table: str, warn_after_days: int = 30,
              error_after_days: int = 90) -> DataFrame:
    """Age of the newest load against warn / error thresholds."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    now = as_ntz(as_of)
    age_h = F.timestamp_diff("HOUR", F.col("max_loaded_at"), now)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age_h > F.lit(error_after_days * 24), F.lit("error"))
              .when(age_h > F.lit(warn_after_days * 24), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return newest.select(F.lit(table).alias("table_name"), F.lit(column).alias("loaded_at_field"),
                         "max_loaded_at", now.alias("as_of"), age_h.cast("bigint").alias("age_hours"),
                         status.alias("status"))


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


class QualityError(RuntimeError):
    pass


def assert_checks(checks: DataFrame) -> None:
    """Raise when any check failed (the collected frame has one row per check)."""
    failed = checks.filter(F.col("status") != "pass").collect()
    if failed:
        lines = ", ".join(f"{r['check']}({r['table_name']}.{r['column_name']})={r['failures']}"
                          for r in failed)
        raise QualityError(f"{len(failed)} data-quality checks failed: {lines}")
