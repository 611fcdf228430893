"""Deterministic systematic sample: every ``stride``-th row of a total order.

``stride = max(1, total // n)`` and at most ``n`` rows are kept.  The global
position comes from the distributed index (``operators.rank``), so no row is
funnelled through one task; under a total order the result does not depend on
partitioning (ties in a partial order fall to a row id, which does).
When ``total < 2n`` the stride is 1 and the sample is the first ``n`` rows of
the order -- the defined behaviour of a systematic sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.rank import with_global_index


def systematic_sample(df: DataFrame, n: int, order_by: Sequence[str | Column],
                      index_col: str = "_index") -> DataFrame:
    if n < 1:
        raise ValueError("sample size must be >= 1")
    indexed, total = with_global_index(df, order_by, index_col, spread_ties=True)
    stride = max(1, total // n)
    idx = F.col(index_col)
    return indexed.filter((F.pmod(idx, F.lit(stride)) == 0) & (idx < F.lit(n * stride)))


def systematic_sample_files(spark, path: str, n: int, index_col: str = "_index") -> DataFrame:
    """Systematic sample of a Parquet table in *file order* (files by path,
    rows by their position inside the file) -- the order of lines in the
    source, with no sort and no shuffle of the data.

    Global position = offset of the file + Parquet row index.  The offsets
    come from one aggregate with one row per file, which Spark broadcasts or
    shuffles by its measured size; the cost is one extra metadata pass.
    """
    if n < 1:
        raise ValueError("sample size must be >= 1")
    df = spark.read.parquet(path)
    data_cols = df.columns
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    per_file = tagged.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    w_prev = F.sum("_n").over(_file_order_window()) - F.col("_n")
    offsets = per_file.select("_file", w_prev.alias("_offset"), "_n")
    total = offsets.agg(F.sum("_n")).first()[0] or 0
    stride = max(1, total // n)
    offsets = offsets.select("_file", "_offset")
    idx = (F.col("_offset") + F.col("_row")).alias(index_col)
    out = tagged.join(offsets, "_file").select(*data_cols, idx)
    i = F.col(index_col)
    return out.filter((F.pmod(i, F.lit(stride)) == 0) & (i < F.lit(n * stride)))


def _file_order_window():
    # runs over the per-file counts only (one row per file), never over data rows
    from pyspark.sql import Window
    return Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
