"""Idempotent, append-only bronze table keyed by ``_source_file``.

The table is Parquet partitioned by ``_source_file``.  Next to the data, in
the hidden folder ``_ledger`` (Spark's file index skips ``_``-prefixed
folders), one row per batch is appended *after* the batch's data has
committed.  A batch counts as loaded only when its ledger row exists, so:

* a re-run of a loaded batch is a no-op, decided before the source is read;
* a run that died after writing (some of) a batch's files but before its
  ledger row re-lands the batch, and because the data write is a dynamic
  overwrite of that batch's own partition, partial files are replaced, never
  duplicated.

Tables written without a ledger (older or foreign ones) fall back to the
partition list, answered by partition pruning.

A batch name is text, whatever it looks like (``007``, ``2024``, ``1e3``,
``2024-01-01``): every read of the table and of its ledger gives the schema, so
that Spark doesn't infer a type for ``_source_file`` from the folder names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import as_ntz
from ledgerline.session import parquet_exists, read_partitioned
from ledgerline.sources.raw import (
    LOAD_TS_COL, PII_COLUMNS, SOURCE_FILE_COL, bronze_schema, now_utc, stamp, validate_source_name,
)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the bronze folder holds at least one landed batch."""
    return parquet_exists(spark, path)


LEDGER_DIR = "_ledger"
LEDGER_SCHEMA = (f"{SOURCE_FILE_COL} string, rows bigint, {LOAD_TS_COL} timestamp_ntz, "
                 "committed_at timestamp_ntz")
# Up to so many committed batches are named in a partition filter; more are joined.
FILTERED_NAMES = 1000


def ledger_path(path: str) -> str:
    return path.rstrip("/") + "/" + LEDGER_DIR


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The committed batches: those with a ledger row (all, in a table that
    has no ledger).  While they are few their names are a partition filter, so
    the folder of a batch that died before its commit isn't read; beyond
    that they are a semi join, which drops its rows after reading them."""
    rows, ledger = read_partitioned(spark, path, [SOURCE_FILE_COL]), read_ledger(spark, path)
    if ledger is None:
        return rows
    names = ledger.select(SOURCE_FILE_COL).distinct()
    few = [r[0] for r in names.take(FILTERED_NAMES + 1)]
    if len(few) <= FILTERED_NAMES:
        return rows.filter(F.col(SOURCE_FILE_COL).isin(*few))
    return rows.join(names, SOURCE_FILE_COL, "left_semi").select(*rows.columns)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    lp = ledger_path(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(lp) if parquet_exists(spark, lp) else None


def loaded_sources(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The subset of ``names`` already loaded (one pruned scan for all)."""
    ledger = read_ledger(spark, path)
    if ledger is not None:
        src = ledger.select(SOURCE_FILE_COL)
    elif table_exists(spark, path):
        src = read_partitioned(spark, path, [SOURCE_FILE_COL]).select(SOURCE_FILE_COL)
    else:
        return spark.createDataFrame([], f"{SOURCE_FILE_COL} string")
    return src.filter(F.col(SOURCE_FILE_COL).isin(*names)).distinct()


def already_loaded(spark: SparkSession, path: str, source_file: str) -> bool:
    """Ledger lookup (partition-pruned fallback); the name is bound as a
    literal value, never spliced into SQL text."""
    validate_source_name(source_file)
    return not loaded_sources(spark, path, [source_file]).isEmpty()


def ensure_ledger(spark: SparkSession, path: str) -> None:
    """Create the (empty) ledger of a new table before any data lands, so the
    table is in ledger mode from its first write."""
    if read_ledger(spark, path) is None and not table_exists(spark, path):
        spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(ledger_path(path))


def partition_path(path: str, source_file: str) -> str:
    """Folder of one batch.  Safe names use only ``[A-Za-z0-9._/-]``; of these
    Spark escapes just ``/`` (as ``%2F``) in partition folder names."""
    validate_source_name(source_file)
    return f"{path.rstrip('/')}/{SOURCE_FILE_COL}={source_file.replace('/', '%2F')}"


def read_batches(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Only the given batches' folders (no listing of the whole table)."""
    return read_partitioned(spark, [partition_path(path, n) for n in names], [SOURCE_FILE_COL], path)


def write_batches(df: DataFrame, path: str, names: list[str] | None = None) -> None:
    """Land the batches in ``df`` (stamped, bronze schema): dynamic overwrite
    of exactly their ``_source_file`` partitions, then one ledger row per
    batch.  Safe to repeat after a crash at any point.

    ``names`` (the batch names in ``df``) should be passed when known:
    otherwise they are read from ``df``, which re-evaluates its source.
    """
    spark = df.sparkSession
    ensure_ledger(spark, path)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(SOURCE_FILE_COL).option("compression", "zstd").parquet(path))
    if names is None:
        names = [r[0] for r in df.select(SOURCE_FILE_COL).distinct().collect()]
    if not names:
        return
    landed = (read_batches(spark, path, names)
              .groupBy(SOURCE_FILE_COL).agg(F.count(F.lit(1)).alias("rows"),
                                            F.max(LOAD_TS_COL).alias(LOAD_TS_COL)))
    (landed.select(SOURCE_FILE_COL, "rows", LOAD_TS_COL, as_ntz(now_utc()).alias("committed_at"))
     .write.mode("append").parquet(ledger_path(path)))


def loaded_rows_sql(spark: SparkSession, table: str, source_file: str) -> int:
    """Row count of one batch in a catalog table or view, with the name bound
    as a SQL parameter (``spark.sql(..., args=...)``), never spliced in."""
    validate_source_name(source_file)
    if not table.replace(".", "").replace("_", "").isalnum():
        raise ValueError(f"bad table name {table!r}")
    return spark.sql(f"SELECT count(*) FROM {table} WHERE {SOURCE_FILE_COL} = :source_file",
                     args={"source_file": source_file}).first()[0]


def row_count(spark: SparkSession, path: str) -> int:
    """Rows in the table: from the ledger (one row per batch, so no file
    listing or footer reads over the data) when there is one, else a count."""
    ledger = read_ledger(spark, path)
    if ledger is not None:
        per_batch = ledger.groupBy(SOURCE_FILE_COL).agg(F.max("rows").alias("rows"))
        return int(per_batch.agg(F.sum("rows")).first()[0] or 0)
    return spark.read.parquet(path).count() if table_exists(spark, path) else 0


def ingest_batch(spark: SparkSession, path: str, source_file: str,
                 read: Callable[[], DataFrame] | DataFrame, load_ts=None,
                 pii=PII_COLUMNS) -> int:
    """Append one batch unless ``source_file`` is already in the table.

    ``read`` is a DataFrame or a zero-argument callable producing it; the
    callable form is only invoked when the batch is new, so a re-run never
    reads the source.  Returns the table's row count after the call.
    """
    validate_source_name(source_file)
    if already_loaded(spark, path, source_file):
        return row_count(spark, path)
    df = read() if callable(read) else read
    raw_cols = [c for c in df.columns if c not in (SOURCE_FILE_COL, LOAD_TS_COL)]
    schema = bronze_schema(raw_cols, pii)
    stamped = stamp(df.select(*raw_cols), source_file, load_ts)
    stamped = stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    write_batches(stamped, path, [source_file])
    return row_count(spark, path)


def bronze_view(spark: SparkSession, path: str) -> DataFrame:
    """Bronze with the column order of the landed schema (partition column
    moved back before ``_load_ts``)."""
    df = read_bronze(spark, path)
    raw = [c for c in df.columns if c not in (SOURCE_FILE_COL, LOAD_TS_COL)]
    return df.select(*raw, SOURCE_FILE_COL, LOAD_TS_COL)
