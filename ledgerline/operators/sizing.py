"""Sorting of small results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sort_bounded(df: DataFrame, *cols) -> DataFrame:
    """Total order for a result whose row count is bounded by its grouping
    keys (days x types, a handful of segments).  The aggregate before it
    stays parallel; only the bounded output moves, through one small
    exchange, into a single sorting task -- no range-partition sampling job.
    Not for data-sized frames: use ``orderBy`` there."""
    return df.repartition(1).sortWithinPartitions(*cols)
