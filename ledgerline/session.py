"""SparkSession construction and the shared work folder.

Every job in the package is timezone-free: the event clock and the arrival
clock are ``TIMESTAMP_NTZ`` values (UTC wall clock), so results do not depend
on ``spark.sql.session.timeZone``.  The session still pins UTC so that any
zoned value a user brings in behaves the same on every executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Settings every ledgerline job relies on; applied by ``get_session`` and safe
# to set on an existing session (all are runtime SQL confs).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's runtime settings.

    ``master`` is only for local runs and tests; on a cluster the launcher
    decides.  The web UI stays off: jobs here are batch and non-interactive.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)


SCRATCH_KEY = "ledgerline.scratch.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the
    cluster names), read from the session.  Only when it is unset -- local
    runs and tests -- is a folder under the system temp directory created and
    registered with ``SparkContext.setCheckpointDir`` (``spark.checkpoint.dir``
    itself cannot be changed at run time); the choice is remembered in the
    session under ``ledgerline.scratch.dir``.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if not conf:
        try:
            conf = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect exposes no SparkContext
            conf = None
    if conf:
        _register_checkpoint_dir(spark, conf)
        return conf.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master.startswith("local[") or master == "local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.conf.set(SCRATCH_KEY, local)
    _register_checkpoint_dir(spark, local)
    return local


def _register_checkpoint_dir(spark: SparkSession, path: str) -> None:
    try:
        sc = spark.sparkContext
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
    except Exception:
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "ledgerline", f"{name}-{uuid.uuid4().hex[:12]}")


def parquet_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable Parquet table (any data file or
    partition folder).  Uses only the DataFrame reader, so it works the same
    on a classic session and over Spark Connect."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the file listing
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or no file in it
            return False
        raise


def read_partitioned(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str],
                     base: str | None = None) -> DataFrame:
    """Parquet folders partitioned by the columns ``names``, whose values stay
    the strings that they were written as.

    Without a schema Spark gives a partition column the type that its folder
    names look like: batches ``007`` and ``2024`` become the integers 7 and
    2024, ``2024-01-01`` a date, ``1e3`` the number 1000.0, and a later cast
    cannot bring the names back.  ``base`` is the table's folder when
    ``paths`` are some of its partitions.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("basePath", base) if base else spark.read
    seen = reader.parquet(*paths).schema
    schema = StructType([StructField(f.name, StringType(), f.nullable) if f.name in names else f for f in seen])
    return reader.schema(schema).parquet(*paths)


def scale_profile(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                  min_partitions: int = 200) -> dict[str, str]:
    """Size shuffles and scan splits for an input of ``input_bytes``.

    Shuffle partitions are set high enough that each holds about
    ``target_partition_bytes`` of the largest stage (input size as the upper
    bound), and AQE coalesces small ones back to that advisory size -- so
    partitions fit executor memory at 100 TB without leaving thousands of
    tiny tasks at small scale.  Scan splits use the same size.  Returns the
    settings applied (all runtime SQL confs).
    """
    n = max(min_partitions, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
