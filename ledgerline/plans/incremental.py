"""Incremental silver: per-run cost follows the new bronze batches.

A full rebuild re-stages and re-deduplicates all of bronze on every run.
Here only batches not yet processed are staged, and:

* their eligible rows are merged into ``silver.transactions`` with the same
  latest-wins order (``operators.upsert.merge_latest``).  Silver is
  partitioned by event time, which the key fixes (the key embeds the step),
  so only the folders the new rows touch are rewritten.  A folder holds a
  day, a month or a year: the finest unit whose folders are worth a file
  (``unit_for``), by the measured rows of a day.  A table that outgrows its
  unit is laid out anew, which happens twice at most.  The winner per key
  is the maximum over the old winner and the new rows, which equals the
  maximum over all rows, so the table equals a full rebuild.
* their quarantined rows replace exactly their ``_source_file`` partitions of
  the quarantine table (dynamic overwrite, so a retry never duplicates);
* per-batch audit statistics (rows and parsed amounts: bronze, eligible,
  quarantine) replace their partitions of a small statistics table, and the
  audit row is assembled from those statistics plus one narrow aggregate
  over silver -- no re-scan of bronze.
* the processed batch names are appended to silver's own ``_batches``
  ledger last, so a run that dies earlier is simply processed again (every
  write above is idempotent).
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.columns import as_ntz
from ledgerline.operators.upsert import merge_latest
from ledgerline.plans import silver
from ledgerline.session import parquet_exists, read_partitioned, scratch_path
from ledgerline.sources import bronze as bronze_table
from ledgerline.sources.raw import SOURCE_FILE_COL, now_utc

# Rewrite units of silver: partition column and about how many days it covers.
UNITS = {"day": ("_event_date", 1), "month": ("_event_month", 30), "year": ("_event_year", 365)}
# Rows below which a folder isn't worth its own files (some 25 MB).
FOLDER_ROWS = 250_000
STATS_COLUMNS = ("bronze_rows", "bronze_amount", "eligible_rows", "eligible_amount",
                 "quarantine_rows", "quarantine_amount")


def paths(root: str) -> dict[str, str]:
    base = os.path.join(root, "silver")
    return {"transactions": os.path.join(base, "transactions"),
            "quarantine": os.path.join(base, "transactions_quarantine"),
            "stats": os.path.join(base, "_batch_stats"),
            "batches": os.path.join(base, "_batches")}


BATCHES_SCHEMA = f"{SOURCE_FILE_COL} string, processed_at timestamp_ntz"


def new_batches(spark: SparkSession, bronze_path: str, root: str) -> DataFrame:
    """Names landed in bronze (its ledger) and not yet processed here."""
    landed = bronze_table.read_ledger(spark, bronze_path)
    if landed is None:
        landed = bronze_table.read_bronze(spark, bronze_path)
    landed = landed.select(SOURCE_FILE_COL).distinct()
    done_path = paths(root)["batches"]
    if parquet_exists(spark, done_path):
        done = spark.read.schema(BATCHES_SCHEMA).parquet(done_path)
        landed = landed.join(done.select(SOURCE_FILE_COL), SOURCE_FILE_COL, "left_anti")
    return landed


def unit_for(rows_per_day: float) -> str:
    """The finest unit of which a folder has ``FOLDER_ROWS``; else a year."""
    return next((u for u, (_, days) in UNITS.items() if rows_per_day * days >= FOLDER_ROWS), "year")


def _rows_per_day(rows: DataFrame) -> float:
    """The size of the day in which the average row lies."""
    days = rows.groupBy(F.to_date("event_ts")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return days.agg(F.try_divide(F.sum(F.col("n") * F.col("n")), F.sum("n"))).first()[0] or 0.0


def table_unit(spark: SparkSession, path: str) -> str | None:
    """The unit of a stored table, which the name of its partition column says."""
    columns = spark.read.parquet(path).columns if parquet_exists(spark, path) else []
    return next((u for u, (column, _) in UNITS.items() if column in columns), None)


def outgrown(spark: SparkSession, path: str, unit: str) -> bool:
    """Whether the table's days now ask for a finer unit.  Only tables of
    coarse units, small ones, are looked at: one narrow pass over a column."""
    if unit == "day":
        return False
    return list(UNITS).index(unit_for(_rows_per_day(spark.read.parquet(path)))) < list(UNITS).index(unit)


def update_silver(spark: SparkSession, bronze_path: str, root: str, buckets: int | None = None) -> int:
    """Process the new batches; returns how many there were.  ``buckets``
    (new silver tables only) adds key buckets under the event folders, so a
    merge rewrites (unit, bucket) folders; left out, their number follows from
    the rows of a folder."""
    p = paths(root)
    # a full run leaves a table without event folders, and a table can outgrow
    # its unit: start over from all batches
    exists, unit = parquet_exists(spark, p["transactions"]), table_unit(spark, p["transactions"])
    anew = exists and (unit is None or outgrown(spark, p["transactions"], unit))
    if anew:
        spark.createDataFrame([], BATCHES_SCHEMA).write.mode("overwrite").parquet(p["batches"])
    # batch names, not rows: one entry per landed batch (metadata-sized)
    names = sorted(r[0] for r in new_batches(spark, bronze_path, root).collect())
    if not names:
        return 0
    # only the new batches' folders are listed and read
    staged = silver.stage(bronze_table.read_batches(spark, bronze_path, names))
    stg_path = scratch_path(spark, "stg-new")
    staged.write.parquet(stg_path)  # written once, read by the three consumers below
    staged = spark.read.parquet(stg_path)

    how = "static" if anew else "dynamic"

    def write_quarantine():
        (silver.quarantine(staged).write.mode("overwrite").option("partitionOverwriteMode", how)
         .partitionBy(SOURCE_FILE_COL).parquet(p["quarantine"]))

    bad = F.col("_quarantine_reason").isNotNull()
    stats = staged.groupBy(SOURCE_FILE_COL).agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.sum("amount").alias("bronze_amount"),
        F.count_if(~bad).alias("eligible_rows"),
        F.sum(F.when(~bad, F.col("amount"))).alias("eligible_amount"),
        F.count_if(bad).alias("quarantine_rows"),
        F.sum(F.when(bad, F.col("amount"))).alias("quarantine_amount"))

    def write_stats():
        (stats.write.mode("overwrite").option("partitionOverwriteMode", how)
         .partitionBy(SOURCE_FILE_COL).parquet(p["stats"]))

    def merge():
        eligible = silver.clean_eligible(staged)
        chosen = unit_for(_rows_per_day(eligible)) if anew or not exists else unit
        column, _ = UNITS[chosen]
        eligible = eligible.withColumn(column, F.trunc("event_ts", chosen) if chosen != "day" else F.to_date("event_ts"))
        merge_latest(spark, p["transactions"], eligible, "transaction_id", column, silver.DEDUP_ORDER,
                     stage_updates=False,  # eligible reads the staged batch already written above
                     buckets=buckets, replace=anew)

    # three tables that don't depend on each other; each write may be repeated
    with ThreadPoolExecutor(max_workers=3) as pool:
        for written in [pool.submit(job) for job in (merge, write_quarantine, write_stats)]:
            written.result()

    (spark.createDataFrame([(n,) for n in names], f"{SOURCE_FILE_COL} string")
     .withColumn("processed_at", as_ntz(now_utc())).coalesce(1)
     .write.mode("append").parquet(p["batches"]))
    return len(names)


STATS_SCHEMA = ("bronze_rows bigint, bronze_amount decimal(28,2), eligible_rows bigint, "
                "eligible_amount decimal(28,2), quarantine_rows bigint, quarantine_amount decimal(28,2), "
                f"{SOURCE_FILE_COL} string")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that may have no files yet (e.g. no batch has quarantined a
    row): an empty frame with the known schema instead of a failed read.
    Batch names stay strings, also where they are partition folders."""
    if parquet_exists(spark, path):
        return read_partitioned(spark, path, [SOURCE_FILE_COL])
    if schema is None:
        raise FileNotFoundError(f"no table at {path} and no schema to fall back to")
    return spark.createDataFrame([], schema)


def read_silver(spark: SparkSession, root: str, staged_schema=None) -> DataFrame:
    schema = None if staged_schema is None else StructType(
        [f for f in staged_schema.fields if f.name in silver.SILVER_COLUMNS])
    return _read(spark, paths(root)["transactions"], schema).select(*silver.SILVER_COLUMNS)


def read_quarantine(spark: SparkSession, root: str, staged_schema=None) -> DataFrame:
    return _read(spark, paths(root)["quarantine"], staged_schema).select(*silver.STAGED_COLUMNS)


def audit(spark: SparkSession, root: str, staged_schema=None) -> DataFrame:
    """The reconciliation row from per-batch statistics + silver totals
    (one aggregate over a UNION ALL, no join, no bronze scan)."""
    money = "decimal(28,2)"
    stats = _read(spark, paths(root)["stats"], STATS_SCHEMA)
    parts = stats.select(F.lit(0).alias("_p"), *STATS_COLUMNS,
                         F.lit(None).cast("decimal(18,2)").alias("amount")).unionByName(
        read_silver(spark, root, staged_schema).select(F.lit(1).alias("_p"),
                                        *[F.lit(None).cast("bigint" if c.endswith("rows") else money).alias(c)
                                          for c in STATS_COLUMNS], "amount"))
    s0 = F.col("_p") == 0
    a = parts.agg(
        F.coalesce(F.sum(F.when(s0, F.col("bronze_rows"))), F.lit(0)).cast("bigint").alias("bronze_rows"),
        F.coalesce(F.sum(F.when(s0, F.col("quarantine_rows"))), F.lit(0)).cast("bigint").alias("quarantine_rows"),
        F.coalesce(F.sum(F.when(s0, F.col("eligible_rows"))), F.lit(0)).cast("bigint").alias("clean_eligible_rows"),
        F.count_if(~s0).alias("clean_rows"),
        F.sum(F.when(s0, F.col("bronze_amount"))).cast(money).alias("bronze_amount"),
        F.sum(F.when(s0, F.col("quarantine_amount"))).cast(money).alias("quarantine_amount"),
        F.sum(F.when(s0, F.col("eligible_amount"))).cast(money).alias("clean_eligible_amount"),
        F.sum(F.when(~s0, F.col("amount"))).cast(money).alias("clean_amount"))
    zero = F.lit(0).cast(money)
    return a.select(
        "bronze_rows", "quarantine_rows", "clean_eligible_rows", "clean_rows",
        (F.col("clean_eligible_rows") - F.col("clean_rows")).alias("duplicates_removed"),
        (F.col("bronze_rows") == F.col("quarantine_rows") + F.col("clean_eligible_rows")).alias("rows_tie"),
        "bronze_amount", "quarantine_amount", "clean_eligible_amount", "clean_amount",
        (F.coalesce(F.col("bronze_amount"), zero)
         == F.coalesce(F.col("quarantine_amount"), zero)
         + F.coalesce(F.col("clean_eligible_amount"), zero)).alias("amount_tie"))
