"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the blueprint.  Every query reads the driver tables (``events`` +
``customer`` for the payment pipeline, ``lineitem`` for the volume/layout
jobs) over their whole extent; writes, where a query needs them, go to the
session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import layout, quality
from ledgerline.operators.footers import footers
from ledgerline.operators.upsert import high_water_mark, upsert
from ledgerline.plans import gold, governance, incremental, measures, registry, silver
from ledgerline.plans.rollup import rollup
from ledgerline.session import scratch_path
from ledgerline.sources import bronze as bronze_table
from ledgerline.sources import fixture
from ledgerline.sources.raw import RAW_COLUMNS, read_raw
from ledgerline.sources.sample import systematic_sample
from ledgerline.streaming.ingest import ingest_stream

# Parameters of the registered queries.
SAMPLE_ROWS = 1000
TRACE_CELL = ("2023-01-15", "TRANSFER", "high")
FILTER_TYPES = ("TRANSFER", "CASH_OUT")
FILTER_SEGMENTS = ("high",)
FRESHNESS_AS_OF = "2024-03-15 00:00:00"
VOLUME_WINDOW = ("1998-06-08", "1998-06-21")
FRAGMENTS = 24
LAYOUT_FILES = 8
CLUSTER_BY = ("date_key", "transaction_type")
NAMED_BATCHES = (("007", "2024-02-01 00:00:00"), ("2024", "2024-02-02 00:00:00"),
                 ("1e3", "2024-02-03 00:00:00"), ("2024-01-01", "2024-02-04 00:00:00"))
ALL_DAYS = ("0001-01-01", "9999-12-31")


@dataclass
class Chain:
    """Lazy medallion chain over one bronze frame.

    ``silver`` is the deduplicated table as gold consumers read it: written
    once as Parquet to the shared checkpoint folder, so the fact, the calendar
    and the customer profile do not each re-run the dedup, each reads only its
    columns, and a lost executor re-reads files instead of recomputing.  So is
    the account profile, which both account dimensions read.
    """
    bronze: DataFrame
    staged: DataFrame
    eligible: DataFrame
    clean: DataFrame
    _silver: DataFrame | None = None
    _profile: DataFrame | None = None

    @staticmethod
    def _stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    @property
    def silver(self) -> DataFrame:
        if self._silver is None:
            self._silver = self._stored(self.clean, "silver")
        return self._silver

    @property
    def fact(self) -> DataFrame:
        return gold.fact(self.silver)

    @property
    def profile(self) -> DataFrame:
        if self._profile is None:
            self._profile = self._stored(gold.account_profile(self.silver), "profile")
        return self._profile

    @property
    def dim_account(self) -> DataFrame:
        return gold.dim_account(self.profile)

    @property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.silver)

    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.profile)

    def mart(self) -> DataFrame:
        return gold.mart(self.fact, self.dim_date, self.dim_customer())


def chain_from(bronze: DataFrame) -> Chain:
    staged = silver.stage(bronze)
    return Chain(bronze, staged, silver.clean_eligible(staged), silver.clean(staged))


def chain(spark: SparkSession, sf_dir: str) -> Chain:
    return chain_from(fixture.bronze(spark, sf_dir))


# --- sources / ingest -------------------------------------------------------

def q_bronze_stamp(spark, sf_dir):
    return fixture.bronze(spark, sf_dir)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def q_bronze_read(spark, sf_dir):
    """Both batches from CSV; the second one's header is in another order."""
    out = []
    for which, header in ((0, RAW_COLUMNS), (1, tuple(reversed(RAW_COLUMNS)))):
        path = scratch_path(spark, f"raw-csv-{which}")
        _write_csv(fixture.batch(spark, sf_dir, which, stamped=False).select(*header), path)
        out.append(read_raw(spark, path, RAW_COLUMNS))
    return out[0].unionByName(out[1])


def q_bronze_idempotent(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    for which, (name, ts) in ((0, fixture.BATCH_0), (1, fixture.BATCH_1), (0, fixture.BATCH_0)):
        bronze_table.ingest_batch(spark, path, name,
                                  lambda w=which: fixture.batch(spark, sf_dir, w, stamped=False), ts)
    return (bronze_table.read_bronze(spark, path).groupBy("_source_file", "_load_ts")
            .agg(F.count(F.lit(1)).alias("rows")))


def q_bronze_named(spark, sf_dir):
    """Batches whose names look like numbers and dates, through bronze, its
    ledger and incremental silver, each step run again: rows by batch name."""
    table, root = scratch_path(spark, "bronze-named"), scratch_path(spark, "lake-named")
    raw = fixture.raw_rows(spark, sf_dir)
    for _ in range(2):
        for i, (name, ts) in enumerate(NAMED_BATCHES):
            bronze_table.ingest_batch(spark, table, name, lambda i=i: raw.filter(
                F.pmod("event_id", F.lit(len(NAMED_BATCHES))) == i).select(*RAW_COLUMNS), ts)
            incremental.update_silver(spark, table, root)
    counted = {"bronze_rows": bronze_table.read_bronze(spark, table), "silver_rows": incremental.read_silver(spark, root),
               "quarantine_rows": incremental.read_quarantine(spark, root)}
    parts = [df.select("_source_file", F.lit(name).alias("of"), F.lit(1).cast("long").alias("rows")) for name, df in counted.items()]
    parts.append(bronze_table.read_ledger(spark, table).select("_source_file", F.lit("ledger_rows").alias("of"), "rows"))
    return reduce(DataFrame.unionByName, parts).groupBy("_source_file").agg(*[
        F.coalesce(F.sum(F.when(F.col("of") == name, F.col("rows"))), F.lit(0)).alias(name) for name in (*counted, "ledger_rows")])


def q_bronze_stream_once(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    for which in (0, 1):
        _write_csv(fixture.batch(spark, sf_dir, which, stamped=False), f"{landing}/batch-{which}")
    table, ckpt = scratch_path(spark, "bronze-stream"), scratch_path(spark, "stream-ckpt")
    ingest_stream(spark, landing, table, ckpt)
    ingest_stream(spark, landing, table, ckpt)  # re-run: lands nothing
    return bronze_table.read_bronze(spark, table).select(*RAW_COLUMNS)


def q_systematic_sample(spark, sf_dir):
    b = fixture.bronze(spark, sf_dir)
    return systematic_sample(b, SAMPLE_ROWS, b.columns, index_col="sample_index")


# --- silver -----------------------------------------------------------------

def q_stg_transactions(spark, sf_dir):
    return chain(spark, sf_dir).staged


def q_stg_typed(spark, sf_dir):
    return chain(spark, sf_dir).staged.select(
        "step_num", "txn_type", "amount", "old_balance_orig", "new_balance_orig", "old_balance_dest",
        "new_balance_dest", "is_fraud", "is_flagged_fraud", "_source_file", "_load_ts")


def q_stg_keys(spark, sf_dir):
    return chain(spark, sf_dir).staged.select("transaction_id", "orig_account_key", "dest_account_key",
                                              "_source_file")


def q_stg_event_clock(spark, sf_dir):
    return chain(spark, sf_dir).staged.select("step_num", "event_ts")


def q_stg_actor(spark, sf_dir):
    return chain(spark, sf_dir).staged.select("orig_account_key", "orig_account_type",
                                              "dest_account_key", "dest_account_type")


def q_stg_contract(spark, sf_dir):
    return governance.contract_breakdown(chain(spark, sf_dir).staged)


def q_clean_eligible(spark, sf_dir):
    return chain(spark, sf_dir).eligible


def q_transactions(spark, sf_dir):
    return chain(spark, sf_dir).clean


def q_quarantine(spark, sf_dir):
    return silver.quarantine(chain(spark, sf_dir).staged)


def q_dedup_latest(spark, sf_dir):
    c = chain(spark, sf_dir)
    multi = (c.eligible.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("versions"))
             .filter(F.col("versions") > 1))
    return multi.join(c.clean, "transaction_id").select(
        "transaction_id", "versions", "_source_file", "_load_ts", "new_balance_orig")


def q_reconciliation(spark, sf_dir):
    c = chain(spark, sf_dir)
    return silver.reconcile(c.staged, c.clean)


def q_dq_reconciliation(spark, sf_dir):
    return silver.reconciliation_failures(q_reconciliation(spark, sf_dir))


def q_late_arrivals(spark, sf_dir):
    c = chain(spark, sf_dir)
    late = F.col("_source_file") != F.lit(fixture.BATCH_0[0])
    return c.clean.groupBy(F.to_date("event_ts").alias("date_key")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late_rows"),
        F.sum(F.when(late, F.col("amount"))).cast("decimal(28,2)").alias("late_amount"),
        F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"))


def q_raw_ids_absent(spark, sf_dir):
    c = chain(spark, sf_dir)
    return governance.raw_ids_absent(c.clean, c.bronze)


# --- gold -------------------------------------------------------------------

def q_fact_project(spark, sf_dir):
    return chain(spark, sf_dir).fact


def _first_load_fact(spark, sf_dir, path):
    c0 = chain_from(fixture.batch(spark, sf_dir, 0))
    upsert(spark, path, c0.fact, "transaction_id", "date_key")


def q_fact_increment(spark, sf_dir):
    path = scratch_path(spark, "fact")
    _first_load_fact(spark, sf_dir, path)
    return gold.fact(chain(spark, sf_dir).clean, since=high_water_mark(spark, path))


def q_fact_merge(spark, sf_dir):
    path = scratch_path(spark, "fact")
    _first_load_fact(spark, sf_dir, path)
    inc = gold.fact(chain(spark, sf_dir).clean, since=high_water_mark(spark, path))
    upsert(spark, path, inc, "transaction_id", "date_key")
    return spark.read.parquet(path).select(*gold.FACT_COLUMNS)


def q_rerun_idempotent(spark, sf_dir):
    """Full chain run twice over a re-ingested bronze table: the second run
    (every batch already loaded, fact already up to date) changes nothing."""
    path = scratch_path(spark, "bronze")
    root = scratch_path(spark, "lake")
    for _ in range(2):
        for which, (name, ts) in ((0, fixture.BATCH_0), (1, fixture.BATCH_1)):
            bronze_table.ingest_batch(spark, path, name,
                                      lambda w=which: fixture.batch(spark, sf_dir, w, stamped=False), ts)
        result = registry.run(spark, bronze_table.bronze_view(spark, path), root)
    return result.tables["gold.mart_daily_settled_volume"]


def _incremental_lake(spark, sf_dir):
    """Batch 0 lands and is processed; then batch 1 lands and only it is
    staged and merged (plans.incremental)."""
    bpath, root = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    for which, (name, ts) in ((0, fixture.BATCH_0), (1, fixture.BATCH_1)):
        bronze_table.ingest_batch(spark, bpath, name,
                                  lambda w=which: fixture.batch(spark, sf_dir, w, stamped=False), ts)
        incremental.update_silver(spark, bpath, root)
    return root


def q_silver_incremental(spark, sf_dir):
    return incremental.read_silver(spark, _incremental_lake(spark, sf_dir))


def q_audit_incremental(spark, sf_dir):
    return incremental.audit(spark, _incremental_lake(spark, sf_dir))


def q_dim_account(spark, sf_dir):
    return chain(spark, sf_dir).dim_account


def q_customer_originated(spark, sf_dir):
    return gold.customer_originated(chain(spark, sf_dir).clean)


def q_dim_customer(spark, sf_dir):
    return chain(spark, sf_dir).dim_customer()


def q_customer_segment(spark, sf_dir):
    return chain(spark, sf_dir).dim_customer().groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("total_originated_amount").alias("min_volume"),
        F.max("total_originated_amount").alias("max_volume"),
        F.sum("total_originated_amount").cast("decimal(28,2)").alias("total_volume"))


def q_dim_date(spark, sf_dir):
    return chain(spark, sf_dir).dim_date


def q_mart(spark, sf_dir):
    return chain(spark, sf_dir).mart()


def q_rollup_window(spark, sf_dir):
    return rollup(chain(spark, sf_dir).fact)


def q_rollup_lineitem(spark, sf_dir):
    return rollup(fixture.volume_fact(spark, sf_dir), *VOLUME_WINDOW)


# --- measures ---------------------------------------------------------------

def _measure(fn):
    return lambda spark, sf_dir: fn(chain(spark, sf_dir).mart())


def q_mart_filtered(spark, sf_dir):
    return measures.apply_filters(chain(spark, sf_dir).mart(), FILTER_TYPES, FILTER_SEGMENTS)


# --- quality ----------------------------------------------------------------

def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    c = chain(spark, sf_dir)
    dim_date = c.dim_date
    dim_customer = c.dim_customer()
    return {
        "bronze.transactions_raw": c.bronze,
        "silver.stg_transactions": c.staged,
        "silver.transactions": c.clean,
        "silver.transactions_quarantine": silver.quarantine(c.staged),
        "silver.audit_silver_reconciliation": silver.reconcile(c.staged, c.clean),
        "gold.dim_transaction_type": gold.dim_transaction_type(spark),
        "gold.dim_date": dim_date,
        "gold.dim_account": c.dim_account,
        "gold.dim_customer": dim_customer,
        "gold.fact_transaction": c.fact,
        "gold.mart_daily_settled_volume": gold.mart(c.fact, dim_date, dim_customer),
    }


def _checks_of(kinds):
    def run(spark, sf_dir):
        tables = _tables(spark, sf_dir)
        frames = []
        for m in registry.MODELS:
            specs = tuple(s for s in m.checks if s[0] in kinds)
            if specs:
                sub = registry.Model(m.name, m.layer, m.depends_on, m.build, m.materialized,
                                     m.partition_by, specs)
                frames += registry.model_checks(sub, tables[m.qualified], tables)
        return quality.union_checks(frames)
    return run


def q_dq_freshness(spark, sf_dir):
    return quality.freshness(fixture.bronze(spark, sf_dir), "_load_ts", FRESHNESS_AS_OF,
                             "bronze.transactions_raw")


def q_gate(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return registry.gate(t["gold.fact_transaction"], t["gold.mart_daily_settled_volume"],
                         t["silver.audit_silver_reconciliation"])


# --- governance -------------------------------------------------------------

def q_mask_accounts(spark, sf_dir):
    return governance.read_masked(fixture.bronze(spark, sf_dir))


def q_masked_contract(spark, sf_dir):
    return governance.masked_contract(fixture.bronze(spark, sf_dir))


def q_trace_mart_cell(spark, sf_dir):
    c = chain(spark, sf_dir)
    return governance.trace_mart_cell(*TRACE_CELL, c.fact, c.dim_customer(), c.bronze)


# --- layout -----------------------------------------------------------------

@dataclass
class Layouts:
    fragmented: str
    zordered: str | None
    compacted: str | None


def build_layouts(spark, sf_dir, n_files: int = LAYOUT_FILES,
                  want: tuple[str, ...] = ("compacted", "zordered")) -> Layouts:
    """The fragmented table plus the rewrites a query needs."""
    src = fixture.volume_fact(spark, sf_dir)
    frag, comp, zord = (scratch_path(spark, n) for n in ("frag", "compact", "zorder"))
    layout.fragment(src, "transaction_id", FRAGMENTS, frag)
    if "compacted" in want:
        layout.compact(spark, frag, comp, target_bytes=_target_bytes(spark, frag, n_files)[0])
    if "zordered" in want:
        layout.zorder(spark, frag, zord, CLUSTER_BY, n_files=n_files)
    return Layouts(frag, zord if "zordered" in want else None, comp if "compacted" in want else None)


def _type_totals(df: DataFrame, *also: str) -> DataFrame:
    return df.groupBy(*also, "transaction_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(28,2)").alias("amount"),
        F.count_if(F.col("is_fraud")).alias("fraud_rows"))


def q_layout_fragment(spark, sf_dir):
    """One row per file: its shard, how many shards it holds, rows, amount."""
    path = scratch_path(spark, "frag")
    layout.fragment(fixture.volume_fact(spark, sf_dir), "transaction_id", FRAGMENTS, path)
    shard = layout.crc32_shard("transaction_id", FRAGMENTS)
    rows = spark.read.parquet(path).select("amount", shard.alias("shard"), F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(
        F.min("shard").alias("shard"), F.count_distinct("shard").alias("shards"), F.count(F.lit(1)).alias("rows"),
        F.sum("amount").cast("decimal(28,2)").alias("amount")).drop("file")


def _day_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(28,2)").alias("amount"))


def _target_bytes(spark, fragmented: str, n_files: int = LAYOUT_FILES) -> tuple[int, int]:
    """The size of a file of which the table takes ``n_files``; its whole size."""
    size = layout.detail(spark, fragmented).first()["size_bytes"]
    return max(1, size // n_files + 1), size


def compact_report(spark, before: str, after: str) -> DataFrame:
    """The compacted table's totals by day, and whether its files are as few,
    as large and as even as was asked."""
    target, size = _target_bytes(spark, before)
    holds = layout.compaction_holds(footers(spark, after), target, size).first()["holds"]
    return _day_totals(spark.read.parquet(after)).withColumn("files_as_asked", F.lit(holds))


def q_layout_compact(spark, sf_dir):
    lay = build_layouts(spark, sf_dir, want=("compacted",))
    return compact_report(spark, lay.fragmented, lay.compacted)


def zorder_report(spark, path: str) -> DataFrame:
    """The clustered table's totals by cell, whether its files follow each
    other on the Morton key, and whether their min/max boxes are right."""
    ordered = layout.in_zorder(spark, path, CLUSTER_BY).first()["holds"]
    boxes = layout.boxes_hold(spark, path, CLUSTER_BY).first()["holds"]
    return _type_totals(spark.read.parquet(path), "date_key").withColumns(
        {"files_in_order": F.lit(ordered), "boxes_hold": F.lit(boxes)})


def q_layout_zorder(spark, sf_dir):
    return zorder_report(spark, build_layouts(spark, sf_dir, want=("zordered",)).zordered)


def q_layout_rollup_equal(spark, sf_dir):
    """The rollup of every day, before and after the rewrite."""
    lay = build_layouts(spark, sf_dir, want=("zordered",))
    keys = ["date_key", "transaction_type"]
    a, b = (rollup(spark.read.parquet(p), *ALL_DAYS, ordered=False) for p in (lay.fragmented, lay.zordered))
    vals = ["settled_amount", "transaction_count", "fraud_count"]
    j = a.alias("a").join(b.alias("b"), keys, "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{v}").eqNullSafe(F.col(f"b.{v}")) for v in vals])
    return j.select(*keys, *[F.coalesce(F.col(f"a.{v}"), F.col(f"b.{v}")).alias(v) for v in vals],
                    same.alias("equal"))


def q_layout_detail(spark, sf_dir):
    """Files and rows of each layout."""
    lay = build_layouts(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        layout.detail(spark, p).select(F.lit(n).alias("layout"), "num_files", "num_rows", (F.col("size_bytes") > 0).alias("has_bytes"))
        for n, p in (("fragmented", lay.fragmented), ("compacted", lay.compacted), ("zordered", lay.zordered))])


def profile_report(spark, name: str, path: str) -> DataFrame:
    """File skipping for the window, held against the files' own footers: the
    manifest's rows to read, the rows of the files that the scan opened and
    the rows of the files whose own box overlaps the window are one number."""
    m = layout.write_manifest(spark, path, CLUSTER_BY)
    prof = layout.profile(spark.read.parquet(m), "date_key", *VOLUME_WINDOW).first()
    own = layout.box_rows(footers(spark, path, ["date_key"]), "date_key", *VOLUME_WINDOW).first()
    inside = F.col("date_key").between(*[F.lit(x) for x in VOLUME_WINDOW])
    seen = layout.opened(spark, path, m, "date_key", *VOLUME_WINDOW).agg(
        F.count(F.lit(1)).alias("rows_opened"), F.count_if(inside).alias("window_rows"))
    return seen.select(
        F.lit(name).alias("layout"), F.lit(own["rows_total"]).cast("long").alias("rows_total"), "window_rows",
        ((F.col("rows_opened") == own["box_rows"]) & F.lit(prof["rows_read"] == own["box_rows"])).alias("reads_its_boxes"),
        F.lit(prof["files_read"] + prof["files_pruned"] == prof["files_total"]).alias("all_files_counted"),
        (F.col("rows_opened") < own["rows_total"]).alias("prunes"))


def q_layout_profile(spark, sf_dir):
    lay = build_layouts(spark, sf_dir, want=("zordered",))
    return profile_report(spark, "fragmented", lay.fragmented).unionByName(profile_report(spark, "zordered", lay.zordered))


def q_layout_benchmark(spark, sf_dir):
    """The window's cost before and after clustering: measure, before, after
    and the relative change."""
    frag, clustered = (scratch_path(spark, n) for n in ("frag", "cells"))
    layout.fragment(fixture.volume_fact(spark, sf_dir), "transaction_id", FRAGMENTS, frag)
    layout.zorder_cells(spark, frag, clustered, CLUSTER_BY, n_files=LAYOUT_FILES)
    before, after = (layout.benchmark(spark, p, "date_key", *VOLUME_WINDOW).drop("bytes_read") for p in (frag, clustered))
    return layout.compared(before, after)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_stamp": q_bronze_stamp,
    "bronze_read": q_bronze_read,
    "bronze_idempotent": q_bronze_idempotent,
    "bronze_named": q_bronze_named,
    "bronze_stream_once": q_bronze_stream_once,
    "systematic_sample": q_systematic_sample,
    "stg_transactions": q_stg_transactions,
    "stg_typed": q_stg_typed,
    "stg_keys": q_stg_keys,
    "stg_event_clock": q_stg_event_clock,
    "stg_actor": q_stg_actor,
    "stg_contract": q_stg_contract,
    "clean_eligible": q_clean_eligible,
    "transactions": q_transactions,
    "quarantine": q_quarantine,
    "dedup_latest": q_dedup_latest,
    "reconciliation": q_reconciliation,
    "dq_reconciliation": q_dq_reconciliation,
    "late_arrivals": q_late_arrivals,
    "raw_ids_absent": q_raw_ids_absent,
    "fact_project": q_fact_project,
    "fact_increment": q_fact_increment,
    "fact_merge": q_fact_merge,
    "rerun_idempotent": q_rerun_idempotent,
    "silver_incremental": q_silver_incremental,
    "audit_incremental": q_audit_incremental,
    "dim_account": q_dim_account,
    "customer_originated": q_customer_originated,
    "dim_customer": q_dim_customer,
    "customer_segment": q_customer_segment,
    "dim_date": q_dim_date,
    "mart": q_mart,
    "rollup_window": q_rollup_window,
    "rollup_lineitem": q_rollup_lineitem,
    "kpi_totals": _measure(measures.kpi_totals),
    "kpi_fraud_rate": _measure(measures.kpi_fraud_rate),
    "avg_ticket_by_type": _measure(measures.avg_ticket_by_type),
    "fraud_rate_by_type": _measure(measures.fraud_rate_by_type),
    "volume_by_type": _measure(measures.volume_by_type),
    "count_by_type": _measure(measures.count_by_type),
    "volume_by_segment": _measure(measures.volume_by_segment),
    "trend_daily": _measure(measures.trend_daily),
    "filter_options": _measure(measures.filter_options),
    "mart_filtered": q_mart_filtered,
    "dq_unique": _checks_of({"unique"}),
    "dq_not_null": _checks_of({"not_null"}),
    "dq_accepted_values": _checks_of({"accepted_values"}),
    "dq_relationships": _checks_of({"relationships"}),
    "dq_freshness": q_dq_freshness,
    "gate": q_gate,
    "mask_accounts": q_mask_accounts,
    "masked_contract": q_masked_contract,
    "trace_mart_cell": q_trace_mart_cell,
    "layout_fragment": q_layout_fragment,
    "layout_compact": q_layout_compact,
    "layout_zorder": q_layout_zorder,
    "layout_rollup_equal": q_layout_rollup_equal,
    "layout_detail": q_layout_detail,
    "layout_profile": q_layout_profile,
    "layout_benchmark": q_layout_benchmark,
}

# Queries whose output depends on file layout (rows-only check, no oracle).
ROWS_ONLY: tuple[str, ...] = ()

