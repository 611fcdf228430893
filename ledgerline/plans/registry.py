"""Model registry and runner: build the medallion tables in dependency order,
materialise each one, run its data-quality checks, and stop downstream work
as soon as a check fails.  Finishes with the post-run gate.

Each model declares its layer, inputs, a build function over DataFrames and
its checks as data.  The runner does the I/O; the build functions are pure
DataFrame plans, so Catalyst sees each model whole.
"""

from __future__ import annotations

import os
import time
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.contract import REASONS
from ledgerline.operators import quality
from ledgerline.operators.upsert import commit_watermark, high_water_mark, upsert
from ledgerline.plans import gold, incremental, silver
from ledgerline.session import parquet_exists, read_partitioned, scratch_path
from ledgerline.sources.raw import SOURCE_FILE_COL

# Accepted values used by the data tests.
TXN_TYPES = ("CASH_IN", "CASH_OUT", "TRANSFER", "PAYMENT", "DEBIT")
ACCOUNT_TYPES = ("customer", "merchant")
SEGMENT_NAMES = ("high", "medium", "low")
FLOW_DIRECTIONS = ("inflow", "outflow", "transfer")

SOURCES = ("bronze.transactions_raw",)


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    depends_on: tuple[str, ...]
    build: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    materialized: str = "table"  # view | table | incremental
    partition_by: str | None = None
    checks: tuple = field(default_factory=tuple)

    @property
    def qualified(self) -> str:
        return f"{self.layer}.{self.name}"


def _dim_customer(spark, t):
    accounts = t["gold.dim_account"].filter(F.col("account_type") == "customer")
    orig = gold.customer_originated(t["silver.transactions"])
    prof = accounts.join(orig.withColumnRenamed("customer_key", "account_key"), "account_key", "left")
    prof = prof.select("account_key", "account_type", "first_seen_ts", "last_seen_ts",
                       F.lit(False).alias("_any_merchant"),
                       F.col("total_originated_amount").alias("_orig_amount"),
                       F.coalesce(F.col("originated_txn_count"), F.lit(0)).alias("_orig_count"))
    return gold.dim_customer(prof)


MODELS: tuple[Model, ...] = (
    Model("stg_transactions", "silver", ("bronze.transactions_raw",),
          lambda s, t: silver.stage(t["bronze.transactions_raw"]), "view"),
    Model("transactions", "silver", ("silver.stg_transactions",),
          lambda s, t: silver.clean(t["silver.stg_transactions"]), "table",
          checks=(("unique", "transaction_id"),
                  ("not_null", ("transaction_id", "event_ts", "txn_type", "amount", "orig_account_key",
                                "orig_account_type", "dest_account_key", "dest_account_type",
                                "is_fraud")),
                  ("accepted_values", "txn_type", TXN_TYPES),
                  ("accepted_values", "orig_account_type", ACCOUNT_TYPES),
                  ("accepted_values", "dest_account_type", ACCOUNT_TYPES))),
    Model("transactions_quarantine", "silver", ("silver.stg_transactions",),
          lambda s, t: silver.quarantine(t["silver.stg_transactions"]), "table",
          checks=(("not_null", ("_quarantine_reason",)),
                  ("accepted_values", "_quarantine_reason", REASONS))),
    Model("audit_silver_reconciliation", "silver",
          ("silver.stg_transactions", "silver.transactions"),
          lambda s, t: silver.reconcile(t["silver.stg_transactions"], t["silver.transactions"]),
          "view",
          checks=(("accepted_values", "rows_tie", (True,)),
                  ("accepted_values", "amount_tie", (True,)),
                  ("singular", "reconciliation"))),
    Model("dim_transaction_type", "gold", (), lambda s, t: gold.dim_transaction_type(s), "table",
          checks=(("unique", "transaction_type"), ("not_null", ("transaction_type",)),
                  ("accepted_values", "transaction_type", TXN_TYPES),
                  ("accepted_values", "flow_direction", FLOW_DIRECTIONS))),
    Model("dim_date", "gold", ("silver.transactions",),
          lambda s, t: gold.dim_date(t["silver.transactions"]), "table",
          checks=(("unique", "date_key"), ("not_null", ("date_key",)))),
    Model("dim_account", "gold", ("silver.transactions",),
          lambda s, t: gold.dim_account(t["silver.transactions"]), "table",
          checks=(("unique", "account_key"), ("not_null", ("account_key", "account_type")),
                  ("accepted_values", "account_type", ACCOUNT_TYPES))),
    Model("dim_customer", "gold", ("gold.dim_account", "silver.transactions"), _dim_customer, "table",
          checks=(("unique", "customer_key"), ("not_null", ("customer_key", "segment")),
                  ("accepted_values", "segment", SEGMENT_NAMES))),
    Model("fact_transaction", "gold", ("silver.transactions",),
          lambda s, t: gold.fact(t["silver.transactions"]), "incremental", partition_by="date_key",
          checks=(("unique", "transaction_id"),
                  ("not_null", ("transaction_id", "amount", "date_key", "transaction_type",
                                "orig_account_key", "dest_account_key")),
                  ("relationships", "date_key", "gold.dim_date", "date_key"),
                  ("relationships", "transaction_type", "gold.dim_transaction_type", "transaction_type"),
                  ("relationships", "orig_account_key", "gold.dim_account", "account_key"),
                  ("relationships", "dest_account_key", "gold.dim_account", "account_key"),
                  ("relationships", "orig_customer_key", "gold.dim_customer", "customer_key"))),
    Model("mart_daily_settled_volume", "gold",
          ("gold.fact_transaction", "gold.dim_date", "gold.dim_customer"),
          lambda s, t: gold.mart(t["gold.fact_transaction"], t["gold.dim_date"], t["gold.dim_customer"]),
          "table", partition_by=None,
          checks=(("unique", "mart_key"), ("not_null", ("mart_key", "settled_amount")),
                  ("relationships", "transaction_type", "gold.dim_transaction_type", "transaction_type"),
                  ("accepted_values", "customer_segment", SEGMENT_NAMES))),
)


def count_checks(models=MODELS) -> int:
    n = 0
    for m in models:
        for c in m.checks:
            n += len(c[1]) if c[0] == "not_null" else 1
    return n


def model_checks(model: Model, df: DataFrame, tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The model's tests: all that look at columns in one pass over the table
    (``quality.table_checks``), a singular one by itself."""
    out, columns = [], []
    t = model.qualified
    for spec in model.checks:
        kind = spec[0]
        if kind == "unique":
            columns.append(quality.Check(kind, spec[1]))
        elif kind == "not_null":
            columns += [quality.Check(kind, c) for c in spec[1]]
        elif kind == "accepted_values":
            columns.append(quality.Check(kind, spec[1], values=tuple(spec[2])))
        elif kind == "relationships":
            columns.append(quality.Check(kind, spec[1], parent=(tables[spec[2]], spec[3], spec[2])))
        elif kind == "singular":
            bad = silver.reconciliation_failures(df)
            out.append(quality._row(bad.agg(F.count(F.lit(1)).alias("x")), "singular", t,  # noqa: SLF001
                                    spec[1], F.col("x")))
        else:
            raise ValueError(f"unknown check {kind}")
    return ([quality.table_checks(df, columns, t)] if columns else []) + out


def topo_order(models=MODELS) -> list[Model]:
    by_name = {m.qualified: m for m in models}
    done, order = set(SOURCES), []

    def visit(m: Model, stack=()):
        if m.qualified in done:
            return
        if m.qualified in stack:
            raise ValueError(f"cycle at {m.qualified}")
        for d in m.depends_on:
            if d not in done:
                visit(by_name[d], stack + (m.qualified,))
        done.add(m.qualified)
        order.append(m)

    for m in models:
        visit(m)
    return order


def gate(fact: DataFrame, mart: DataFrame, audit: DataFrame) -> DataFrame:
    """Post-run gate: one row of three booleans, or an exception.

    One aggregate over (fact UNION ALL mart UNION ALL audit) -- no join --
    then ``assert_true`` raises inside the query if the fact or the mart is
    empty or the reconciliation identity is broken (a NULL identity, i.e. an
    empty audit, raises too).
    """
    parts = (fact.select(F.lit(0).alias("_p"), F.lit(None).cast("boolean").alias("_tie"))
             .unionByName(mart.select(F.lit(1).alias("_p"), F.lit(None).cast("boolean").alias("_tie")))
             .unionByName(audit.select(F.lit(2).alias("_p"),
                                       (F.col("rows_tie") & F.col("amount_tie")).alias("_tie"))))
    a = parts.agg(F.count_if(F.col("_p") == 0).alias("fact_rows"),
                  F.count_if(F.col("_p") == 1).alias("mart_rows"),
                  F.bool_and(F.when(F.col("_p") == 2, F.col("_tie"))).alias("ties"))

    def checked(cond, msg):
        return F.coalesce(F.assert_true(cond, msg).cast("boolean"), cond)

    return a.select(
        checked(F.col("fact_rows") > 0, "gate: gold.fact_transaction is empty").alias("fact_ok"),
        checked(F.col("mart_rows") > 0, "gate: gold.mart_daily_settled_volume is empty").alias("mart_ok"),
        checked(F.col("ties"), "gate: silver reconciliation identity is broken").alias("reconciliation_ok"))


@dataclass
class RunResult:
    tables: dict[str, DataFrame]
    checks: list
    gate: list
    timings: dict = field(default_factory=dict)  # model -> (materialise s, checks s)


def _read_back(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The stored table in the model's column order.  An empty partitioned
    write leaves no files, so an empty model reads back as an empty frame of
    its own schema (downstream models and checks then see "empty", and the
    gate reports it)."""
    if parquet_exists(spark, path):
        return spark.read.parquet(path).select(*df.columns)
    return spark.createDataFrame([], df.schema)


def _materialize(spark: SparkSession, m: Model, inputs: dict[str, DataFrame], root: str,
                 materialize_views: bool, fact_buckets: int | None = None) -> DataFrame:
    df = m.build(spark, inputs)
    path = os.path.join(root, m.layer, m.name)
    if m.materialized == "incremental":
        hw = high_water_mark(spark, path)
        # one filtered pass over silver; the upsert (touched dates, rewrite) and
        # the new mark then read this small increment, not silver again
        inc_path = scratch_path(spark, f"{m.name}-increment")
        df.filter(F.col("_load_ts") > F.lit(hw.isoformat(sep=" ")).cast("timestamp_ntz")) \
            .write.parquet(inc_path)
        inc = _read_back(spark, inc_path, df)
        # silver is unique per transaction_id by construction and the fact's
        # own `unique` test runs next, so the upsert's separate duplicate-key
        # aggregation (a full shuffle of the ids) is skipped here
        upsert(spark, path, inc, "transaction_id", m.partition_by or "date_key", check_unique=False,
               stage_updates=False, buckets=fact_buckets)
        # the mark advances only after the upsert committed in full
        commit_watermark(spark, path, inc.agg(F.max("_load_ts")).first()[0])
        return _read_back(spark, path, df)
    if m.materialized == "table" or materialize_views:
        w = df.write.mode("overwrite")
        if m.partition_by:
            w = w.partitionBy(m.partition_by)
        w.parquet(path)
        return _read_back(spark, path, df)
    return df


def _check(m: Model, df: DataFrame, tables: dict[str, DataFrame]) -> list:
    return quality.union_checks(model_checks(m, df, tables)).collect()


def run(spark: SparkSession, bronze: DataFrame, root: str, fail_fast: bool = True,
        materialize_views: bool = True, threads: int = 4, incremental_silver: bool = False,
        bronze_path: str | None = None, fact_buckets: int | None = None,
        silver_buckets: int | None = None) -> RunResult:
    """Build every model into ``root/<layer>/<name>`` and check it.

    Models run as soon as their inputs are built *and* checked, up to
    ``threads`` at a time (independent models -- the dimensions, the fact,
    the quarantine -- are separate Spark jobs that can share the cluster).
    A model's checks additionally wait for the tables their relationship
    tests reference.  When a check fails nothing new is started, work in
    flight finishes, and the failure is raised: what is downstream of a
    failed model is never built.

    ``fact_buckets`` gives a new fact table a second partition level of key
    buckets, so an upsert rewrites (date, bucket) folders instead of days.

    ``incremental_silver`` (needs ``bronze_path``) replaces the full silver
    rebuild by ``plans.incremental.update_silver``: only new bronze batches
    are staged and merged (``silver_buckets`` as for the fact), and the
    silver tables are then checked as usual.
    """
    models = {m.qualified: m for m in topo_order()}
    tables: dict[str, DataFrame] = {"bronze.transactions_raw": bronze}
    built, passed = set(SOURCES), set(SOURCES)
    check_parents = {q: {s[2] for s in m.checks if s[0] == "relationships"} for q, m in models.items()}
    to_build, to_check = list(models), []
    results, timings, errors = [], {}, []
    if incremental_silver:
        if not bronze_path:
            raise ValueError("incremental_silver needs bronze_path (its ledger lists the batches)")
        t0 = time.perf_counter()
        incremental.update_silver(spark, bronze_path, root, silver_buckets)
        staged = silver.stage(bronze)  # lazy: only its schema is used, gold never reads it
        schema = staged.schema
        audit = incremental.audit(spark, root, schema)  # one row: kept, not assembled anew by each check and the gate
        prebuilt = {"silver.stg_transactions": staged,
                    "silver.transactions": incremental.read_silver(spark, root, schema),
                    "silver.transactions_quarantine": incremental.read_quarantine(spark, root, schema),
                    "silver.audit_silver_reconciliation": spark.createDataFrame(audit.collect(), audit.schema)}
        for q, df in prebuilt.items():
            tables[q] = df
            built.add(q)
            to_build.remove(q)
            timings[q] = (round(time.perf_counter() - t0, 3), 0.0)
            if models[q].checks:
                to_check.append(q)
            else:
                passed.add(q)
    running: dict = {}
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        while True:
            if not errors:
                for q in [q for q in to_build if all(d in passed for d in models[q].depends_on)]:
                    to_build.remove(q)
                    inputs = {d: tables[d] for d in models[q].depends_on}
                    fut = pool.submit(_materialize, spark, models[q], inputs, root, materialize_views,
                                      fact_buckets)
                    running[fut] = ("build", q, time.perf_counter())
                for q in [q for q in to_check if check_parents[q] <= built]:
                    to_check.remove(q)
                    fut = pool.submit(_check, models[q], tables[q], dict(tables))
                    running[fut] = ("check", q, time.perf_counter())
            if not running:
                break
            done, _ = wait(list(running), return_when=FIRST_COMPLETED)
            for fut in done:
                kind, q, t0 = running.pop(fut)
                elapsed = round(time.perf_counter() - t0, 3)
                try:
                    out = fut.result()
                except Exception as exc:  # noqa: BLE001 - re-raised below
                    errors.append(exc)
                    continue
                if kind == "build":
                    tables[q] = out
                    built.add(q)
                    timings[q] = (elapsed, 0.0)
                    if models[q].checks:
                        to_check.append(q)
                    else:
                        passed.add(q)
                    continue
                results.extend(out)
                timings[q] = (timings[q][0], elapsed)
                failed = [r for r in out if r["status"] != "pass"]
                if failed and fail_fast:
                    errors.append(quality.QualityError(
                        f"{q}: failed checks {failed}; downstream not built"))
                else:
                    passed.add(q)
    if errors:
        raise errors[0]
    results.sort(key=lambda r: (r["table_name"], r["check"], r["column_name"]))
    g = gate(tables["gold.fact_transaction"], tables["gold.mart_daily_settled_volume"],
             tables["silver.audit_silver_reconciliation"]).collect()
    return RunResult(tables, results, g, timings)


def register_tables(spark: SparkSession, root: str, models=MODELS) -> list[str]:
    """Expose the materialised models as ``<layer>.<name>`` tables in the
    session catalog (external Parquet tables over ``root``), so SQL users can
    write ``SELECT ... FROM gold.mart_daily_settled_volume``.  Partition
    folders of partitioned tables are recovered from storage."""
    names = []
    for m in models:
        path = os.path.join(root, m.layer, m.name)
        if not parquet_exists(spark, path):
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {m.layer}")
        spark.sql(f"DROP TABLE IF EXISTS {m.qualified}")
        spark.catalog.createTable(m.qualified, path=path, source="parquet")
        parts = [c.name for c in spark.catalog.listColumns(m.qualified) if c.isPartition]
        if SOURCE_FILE_COL in parts:  # declared, so that batch names stay strings
            fields = read_partitioned(spark, path, [SOURCE_FILE_COL]).schema.fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            spark.sql(f"DROP TABLE {m.qualified}")
            spark.sql(f"CREATE TABLE {m.qualified} ({columns}) USING parquet PARTITIONED BY ({SOURCE_FILE_COL}) "
                      f"LOCATION '{path}'")
        if parts:
            spark.sql(f"ALTER TABLE {m.qualified} RECOVER PARTITIONS")
        names.append(m.qualified)
    return names
