"""Structured Streaming forms of ingest and upsert.

``ingest_stream``: a file-source stream over a landing folder, run with
``trigger(availableNow=True)``.  The stream's checkpoint remembers which files
were read, so a re-run lands only new files; inside ``foreachBatch`` the
bronze ledger (partition list) additionally drops any batch name already
present, so idempotency holds even with a fresh checkpoint.

``upsert_stream``: micro-batches of silver rows merged into the fact with
latest-load-wins semantics, safe for late and out-of-order batches.  No
watermark is used on purpose: a watermark would drop late rows, and every
late row must be kept and placed by its event clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.operators.dedup import latest_by
from ledgerline.operators.upsert import merge_latest
from ledgerline.sources.bronze import ensure_ledger, read_ledger, write_batches
from ledgerline.sources.raw import (
    LOAD_TS_COL, NA_STRINGS, PII_COLUMNS, RAW_COLUMNS, SOURCE_FILE_COL, bronze_schema, now_utc, read_raw,
    validate_source_name,
)
from ledgerline.functions.columns import as_ntz


def landing_root(spark: SparkSession, in_dir: str) -> str:
    """The landing folder's path on its file system, without scheme and host:
    ``file:/in``, ``file:///in``, ``/in`` and a relative ``in`` are resolved by
    the file system that the name belongs to, the default one if it says none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(in_dir)  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    return path.getFileSystem(conf).makeQualified(path).toUri().getRawPath().rstrip("/") + "/"


def relative_name(root: str):
    """Source name = file path below the landing root, whatever the scheme and
    host that the reader puts in front of it (both paths are URI-encoded)."""
    path = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    outside = F.concat(F.lit(f"not below the landing folder {root}: "), path)
    return F.when(F.startswith(path, F.lit(root)), F.substr(path, F.lit(len(root) + 1))).otherwise(
        F.raise_error(outside).cast("string"))


def ingest_stream(spark: SparkSession, in_dir: str, table_path: str, checkpoint: str,
                  columns: Sequence[str] = RAW_COLUMNS, max_files_per_trigger: int = 1000,
                  na_strings: Sequence[str] = NA_STRINGS, pii: Sequence[str] = PII_COLUMNS) -> None:
    """Land every new CSV file under ``in_dir`` into bronze, once.

    The stream only tells which files are new (at most
    ``max_files_per_trigger`` a micro-batch, which bounds the list of names);
    they are read by the batch reader, under the same contract: columns by
    header name, long rows and missing mask columns refused, names checked
    before anything is written.  Files already in the ledger are left out by
    an anti join.
    """
    bronze_schema(columns, pii)
    name = relative_name(landing_root(spark, in_dir)).alias(SOURCE_FILE_COL)
    named = (spark.readStream.schema(StructType([StructField(c, StringType(), True) for c in columns]))
             .option("header", "true").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", str(max_files_per_trigger)).csv(in_dir)
             .select(name))

    def land(batch: DataFrame, epoch_id: int) -> None:
        ensure_ledger(spark, table_path)
        files, done = batch.distinct(), read_ledger(spark, table_path)
        if done is not None:
            files = files.join(done.select(SOURCE_FILE_COL).distinct(), SOURCE_FILE_COL, "left_anti")
        new = sorted(validate_source_name(r[SOURCE_FILE_COL]) for r in files.collect())
        if new:
            paths = [f"{in_dir.rstrip('/')}/{n}" for n in new]  # as given: the metadata's paths are URI-encoded
            rows = read_raw(spark, paths, columns, na_strings, allow_empty=True, extra=[name])
            # dynamic overwrite of these files' partitions, then their ledger rows
            write_batches(rows.withColumn(LOAD_TS_COL, as_ntz(now_utc())), table_path, new)

    q = (named.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def upsert_stream(spark: SparkSession, source: DataFrame, fact_path: str, checkpoint: str,
                  to_fact, key: str = "transaction_id", partition: str = "date_key",
                  order: Sequence[tuple[str, str]] = (("_load_ts", "desc"),)) -> None:
    """Merge each micro-batch of ``source`` (a streaming frame of silver rows)
    into the fact: dedup inside the batch, then latest-wins merge on the
    touched partitions only."""

    def merge(batch: DataFrame, epoch_id: int) -> None:
        rows = to_fact(batch)
        if rows.isEmpty():
            return
        merge_latest(spark, fact_path, latest_by(rows, key, order), key, partition, order)

    q = (source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
