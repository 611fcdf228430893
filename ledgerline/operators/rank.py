"""Distributed global index and ``ntile`` without a single-partition window.

``ntile(n) OVER (ORDER BY ...)`` with no PARTITION BY makes Spark move every
row into one task.  Here the same result comes from a range-partitioned sort:

1. ``orderBy`` range-partitions and sorts (Spark samples the boundaries; the
   order must be total -- end it with a unique column -- so ties split).
2. The sorted frame is checkpointed to the shared checkpoint folder, which
   fixes partition contents and row order (and cuts lineage, so a lost
   executor re-reads the checkpoint instead of re-sampling boundaries).
3. One aggregate counts rows per partition, and running sums over these counts
   (one row per partition, never a data row) give each partition's offset: a
   small relation, checkpointed.
4. global index = partition offset + position inside the partition
   (``monotonically_increasing_id`` keeps the position in its low 33 bits).
   The offsets are joined by partition id.  They are broadcast while there are
   at most ``BROADCAST_PARTITIONS`` of them (12 MB); beyond that Spark picks
   the join.  No expression and no list on the driver grows with the partitions.

The ntile bucket is then arithmetic on the index: with ``q, r = divmod(N, n)``
the first ``r`` buckets hold ``q + 1`` rows, the rest ``q`` (Spark's rule).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_root

_LOW_BITS = 33
BROADCAST_PARTITIONS = 1_000_000


def partition_offsets(tagged: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows with a partition id ``_pid`` -> (``_pid``, ``_offset``: the rows of
    all partitions before it), the number of partitions that hold rows and of
    rows.  The window runs over the counts, one row per partition."""
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    offsets = counts.select("_pid", before.alias("_offset"), "_n").checkpoint(eager=True)
    parts, rows = offsets.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    return offsets.select("_pid", "_offset"), parts, rows


def place(tagged: DataFrame, offsets: DataFrame, parts: int, index_col: str) -> DataFrame:
    """Global index of rows tagged with partition (``_pid``) and row id
    (``_mid``), from the offsets of their partitions."""
    if parts <= BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _LOW_BITS)
    return tagged.join(offsets, "_pid").withColumn(index_col, F.col("_offset") + local).drop("_pid", "_mid", "_offset")


def with_global_index(df: DataFrame, order: Sequence[Column | str],
                      index_col: str = "_index", spread_ties: bool = False) -> tuple[DataFrame, int]:
    """Add a 0-based dense position under ``order``; returns (frame, row count).

    ``spread_ties``: when ``order`` may repeat (many identical keys), a row id
    is added as the last sort key so a repeated key -- even a third of the
    input -- spreads over many range partitions (range partitioning cannot
    split one repeated key).  The ids are frozen by a reliable checkpoint
    *before* the sort: a recomputed task after an executor loss then sees the
    same ids, so no row can move to another range partition.  Callers whose
    order is already unique (it ends with a key) leave it off.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    keys = list(order)
    tb = "_gidx_tb"
    if spread_ties:
        df = df.withColumn(tb, F.monotonically_increasing_id()).checkpoint(eager=True)
        keys.append(tb)
    ordered = df.orderBy(*keys).checkpoint(eager=True)
    if spread_ties:
        ordered = ordered.drop(tb)
    tagged = ordered.withColumns({"_pid": F.spark_partition_id(),
                                  "_mid": F.monotonically_increasing_id()})
    offsets, parts, total = partition_offsets(tagged)
    return place(tagged, offsets, parts, index_col), total


def tile_of(index: Column, total: int, n: int) -> Column:
    """1-based ntile bucket of a 0-based ``index`` among ``total`` rows."""
    if n < 1:
        raise ValueError("ntile needs n >= 1")
    q, r = divmod(total, n)
    big = r * (q + 1)
    first = (index / F.lit(q + 1)).cast("bigint") + 1
    if q == 0:
        return first.cast("int")
    rest = F.lit(r) + ((index - F.lit(big)) / F.lit(q)).cast("bigint") + 1
    return F.when(index < F.lit(big), first).otherwise(rest).cast("int")


def ntile_global(df: DataFrame, n: int, order: Sequence[Column | str],
                 out_col: str = "ntile") -> DataFrame:
    """``ntile(n) OVER (ORDER BY order)`` computed without a global window."""
    indexed, total = with_global_index(df, order, "_gidx")
    return indexed.withColumn(out_col, tile_of(F.col("_gidx"), total, n)).drop("_gidx")


def global_index(df: DataFrame, order: Sequence[Column | str], index_col: str = "_index") -> DataFrame:
    return with_global_index(df, order, index_col)[0]
