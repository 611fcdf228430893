"""The benchmark rollup: settled amount, count and fraud count by day and
type over an inclusive date window, ordered by both keys.

With the fact partitioned by ``date_key`` the window becomes a partition
filter; on a flat layout it is a pushed Parquet filter (row-group skipping),
and ``operators.layout.skipping_scan`` adds file-level skipping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.sizing import sort_bounded

# The benchmark's inclusive filter window on the event fixture.
WINDOW_LO = "2023-01-08"
WINDOW_HI = "2023-01-21"


def rollup(fact: DataFrame, lo: str = WINDOW_LO, hi: str = WINDOW_HI, ordered: bool = True) -> DataFrame:
    out = (fact.filter(F.col("date_key").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
           .groupBy("date_key", "transaction_type")
           .agg(F.sum("amount").cast("decimal(28,2)").alias("settled_amount"),
                F.count(F.lit(1)).alias("transaction_count"),
                F.count_if(F.col("is_fraud")).cast("bigint").alias("fraud_count")))
    # output is bounded by days in the window x types: sorted in one small task
    return sort_bounded(out, "date_key", "transaction_type") if ordered else out
