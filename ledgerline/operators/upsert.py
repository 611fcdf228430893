"""Keyed upsert (MERGE semantics) on a Parquet table partitioned by a column
that is a function of the key.

Because every key lives in exactly one partition (here ``transaction_id``
fixes ``date_key``), an update can only match inside its own partition.  So
only the partitions the batch touches are read, ``target LEFT ANTI updates``
keeps the untouched rows, the batch is unioned in, and those partitions alone
are rewritten with dynamic partition overwrite.  Cost follows the batch, not
the table.

The rewrite is one job: Spark writes the new files of a dynamic partition
overwrite into a hidden staging folder of the table and swaps the folders when
the job commits, after its last task has read the old ones.  An executor lost
before that re-reads files that are still there.

The rewrite unit is a folder: a day, or a (day, key bucket) pair in tables whose
days are large.  A new table gets as many key buckets as the measured rows of
its days ask for (``sized_buckets``), so that scattered corrections to a table
of large days rewrite the buckets they hit, and a small table isn't cut into
tiny files.
"""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import parquet_exists, scratch_path

# High-water mark used when the target is empty.
EMPTY_HIGH_WATER = "1900-01-01 00:00:00"


def _exists(spark: SparkSession, path: str) -> bool:
    return parquet_exists(spark, path)


WATERMARK_DIR = "_watermark"


def watermark_path(path: str) -> str:
    return path.rstrip("/") + "/" + WATERMARK_DIR


def high_water_mark(spark: SparkSession, path: str, col: str = "_load_ts") -> datetime:
    """The target's committed high-water mark.

    When the target keeps a ``_watermark`` record (appended only after an
    upsert has fully committed) its maximum is used, so a run that died in
    the middle of a partition overwrite is simply processed again.
    Otherwise ``max(col)`` of the target (Parquet statistics keep it
    cheap), or 1900-01-01 when the target is empty or missing.
    """
    empty = datetime.fromisoformat(EMPTY_HIGH_WATER)
    wm = watermark_path(path)
    if _exists(spark, wm):
        v = spark.read.parquet(wm).agg(F.max("high_water_mark")).first()[0]
        return v if v is not None else empty
    if not _exists(spark, path):
        return empty
    v = spark.read.parquet(path).agg(F.max(col)).first()[0]
    return v if v is not None else empty


def commit_watermark(spark: SparkSession, path: str, value: datetime | None) -> None:
    """Append the new high-water mark after a successful upsert (append-only,
    one small file per commit, so a half-written record is never read as a
    lower mark)."""
    if value is None:
        return
    row = spark.createDataFrame([(value,)], "high_water_mark timestamp_ntz")
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    (row.withColumn("committed_at", F.lit(now).cast("timestamp_ntz"))
     .coalesce(1).write.mode("append").parquet(watermark_path(path)))


def increment(source: DataFrame, spark: SparkSession, target_path: str,
              col: str = "_load_ts") -> DataFrame:
    """Rows of ``source`` loaded strictly after the target's high-water mark."""
    hw = high_water_mark(spark, target_path, col)
    return source.filter(F.col(col) > F.lit(hw.isoformat(sep=" ")).cast("timestamp_ntz"))


def _staged(spark: SparkSession, updates: DataFrame, stage_updates: bool) -> DataFrame:
    """The batch is read several times (checks, touched partitions, rewrite);
    staging it once in the shared scratch folder evaluates its source once."""
    if not stage_updates:
        return updates
    p = scratch_path(spark, "upsert-batch")
    updates.write.parquet(p)
    return spark.read.parquet(p).select(*updates.columns)


BUCKET_PREFIX = "_bucket_of_"
# Rows of a folder above which a new table's days are split: some 200 MB of facts.
ROWS_PER_FOLDER = 2_000_000


def sized_buckets(rows: DataFrame, partition: str, rows_per_folder: int = ROWS_PER_FOLDER) -> int:
    """Key buckets for a table of these rows: the size of the day in which the
    average row lies (large days count by their rows), in folders."""
    days = rows.groupBy(partition).agg(F.count(F.lit(1)).cast("double").alias("n"))
    weighted = days.agg(F.try_divide(F.sum(F.col("n") * F.col("n")), F.sum("n"))).first()[0]
    return max(1, math.ceil((weighted or 0) / rows_per_folder))


def bucket_column(spark: SparkSession, path: str, requested: int | None) -> str | None:
    """Name of the key-bucket partition column, ``_bucket_of_<B>``.

    An existing table's own column decides (the bucket count is part of its
    name, so the layout is self-describing and survives any crash); a new
    table uses ``requested``, where less than two means no key buckets.
    """
    if _exists(spark, path):
        cols = [c for c in spark.read.parquet(path).columns if c.startswith(BUCKET_PREFIX)]
        return cols[0] if cols else None
    return f"{BUCKET_PREFIX}{requested}" if requested and requested > 1 else None


def _clustered(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of a folder together, so a task doesn't write a file into every
    folder; adaptive execution splits a hot folder and joins small ones.  Texts
    that are lower-case hexadecimal, as keys that are hashes, move as bytes."""
    sent, back = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if f.name in parts or f.dataType.simpleString() != "string":
            sent.append(c)
            back.append(c)
            continue
        same = F.lower(F.hex(F.unhex(c))) == c
        sent += [F.when(same, F.unhex(c)).alias(f"_bytes_{i}"), F.when(same, F.lit(None)).otherwise(c).alias(f"_text_{i}")]
        back.append(F.coalesce(F.lower(F.hex(f"_bytes_{i}")), F.col(f"_text_{i}")).alias(f.name))
    return df.select(*sent).hint("rebalance", *parts).select(*back)


def repeated(updates: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, and their ``count``.  First hashes
    are counted, a few bytes a row; only keys whose hash repeats are counted
    themselves."""
    hashed = updates.select(F.col(key), F.xxhash64(F.col(key)).alias("_hash"))
    often = hashed.groupBy("_hash").count().filter(F.col("count") > 1).select("_hash")
    if often.isEmpty():
        return updates.select(F.col(key), F.lit(0).cast("long").alias("count")).limit(0)
    return hashed.join(often, "_hash", "left_semi").groupBy(key).count().filter(F.col("count") > 1)


def _rewrite(spark: SparkSession, path: str, updates: DataFrame, key: str, partition: str,
             buckets: int | None, combine, first_write, replace: bool = False) -> int:
    """Partition-scoped rewrite shared by ``upsert`` and ``merge_latest``.

    Only the folders the batch touches -- (date) or (date, key bucket) -- are
    read (static partition filters, narrowed to the exact touched pairs),
    ``combine(current, updates)`` merges them, and those folders alone are
    rewritten by one dynamic partition overwrite.  Returns the number of
    rewritten folders.
    """
    new = replace or not _exists(spark, path)
    if new and buckets is None:
        buckets = sized_buckets(updates, partition)
    bcol = (f"{BUCKET_PREFIX}{buckets}" if buckets > 1 else None) if new else bucket_column(spark, path, buckets)
    parts = [partition]
    if bcol:
        n = int(bcol[len(BUCKET_PREFIX):])
        updates = updates.withColumn(bcol, F.pmod(F.xxhash64(F.col(key)), F.lit(n)))
        parts.append(bcol)
    if new:
        _clustered(first_write(updates), parts).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(*parts).parquet(path)
        return updates.select(*parts).distinct().count()
    # Touched folders: one row per (date[, bucket]) -- bounded by the layout.
    touched = [tuple(r) for r in updates.select(*parts).distinct().collect()]
    if not touched:
        return 0
    target = spark.read.parquet(path)
    dates = [t[0] for t in touched]
    non_null = sorted({d for d in dates if d is not None})
    pred = F.col(partition).isin(*non_null) if non_null else F.lit(False)
    if len(non_null) != len(set(dates)):
        pred = pred | F.col(partition).isNull()
    if bcol:
        pred = pred & F.col(bcol).isin(*sorted({t[1] for t in touched}))
    current = target.filter(pred)  # static partition pruning: touched dates x buckets
    if bcol:
        # narrow the date x bucket superset to exactly the touched pairs
        current = current.join(updates.select(*parts).distinct(), parts, "left_semi")
    merged = combine(current, updates.select(*target.columns))
    (_clustered(merged, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))
    return len(touched)


def upsert(spark: SparkSession, path: str, updates: DataFrame, key: str = "transaction_id",
           partition: str = "date_key", check_unique: bool = True,
           stage_updates: bool = True, buckets: int | None = None) -> int:
    """MERGE ``updates`` into the table at ``path`` on ``key``: rows of the
    batch replace the target rows with the same key, other rows are inserted.

    Returns the number of rewritten partition folders.  A batch holding the
    same key twice is rejected: the result of such a MERGE is ambiguous.
    Pass ``stage_updates=False`` when ``updates`` is already a stored table.

    ``buckets`` (new tables only) adds a second partition level,
    ``pmod(xxhash64(key), B)``: the rewrite unit becomes one (date, bucket)
    folder, so scattered late corrections rewrite the buckets they touch,
    not whole days.  Left out, B follows from the size of the days; 1 is none.
    """
    updates = _staged(spark, updates, stage_updates)
    if check_unique:
        dup = repeated(updates, key)
        if not dup.isEmpty():
            raise ValueError(f"upsert batch has duplicate {key} values, e.g. {dup.first()}")
    return _rewrite(spark, path, updates, key, partition, buckets,
                    lambda cur, upd: cur.join(upd.select(key), key, "left_anti").unionByName(upd),
                    lambda upd: upd)


def merge_latest(spark: SparkSession, path: str, updates: DataFrame, key: str = "transaction_id",
                 partition: str = "date_key", order=(("_load_ts", "desc"),),
                 stage_updates: bool = True, buckets: int | None = None, replace: bool = False) -> int:
    """Upsert where the row that ranks first under ``order`` wins, whether it
    is already in the table or in the batch -- an older correction arriving
    late never overwrites a newer one.  Same partition-scoped rewrite (and
    optional key buckets) as ``upsert``; ``replace`` starts the table anew."""
    from ledgerline.operators.dedup import latest_by

    updates = _staged(spark, updates, stage_updates)
    return _rewrite(spark, path, updates, key, partition, buckets,
                    lambda cur, upd: latest_by(cur.unionByName(upd), key, order),
                    lambda upd: latest_by(upd, key, order), replace)
