"""Governance jobs: masked reads of bronze and tracing a gold figure back to
the raw rows it came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import EVENT_CLOCK_ANCHOR, grain_key, try_int, try_money
from ledgerline.functions.masking import mask_columns
from ledgerline.plans.silver import stage
from ledgerline.sources.bronze import bronze_view
from ledgerline.sources.raw import PII_COLUMNS


def read_masked(bronze: DataFrame, privileged: bool = False) -> DataFrame:
    """Consumer view of bronze: account ids masked unless ``privileged``."""
    return mask_columns(bronze, PII_COLUMNS, privileged)


def contract_breakdown(staged: DataFrame) -> DataFrame:
    """Rows and parsed amount per quarantine reason (NULL = clean)."""
    return staged.groupBy("_quarantine_reason").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("amount").cast("decimal(28,2)").alias("amount"))


def masked_contract(bronze: DataFrame) -> DataFrame:
    """Running the contract on a masked read: every id now starts with '*',
    so no row can be clean -- a consumer read must never feed silver."""
    return contract_breakdown(stage(read_masked(bronze)))


def bronze_with_key(bronze: DataFrame) -> DataFrame:
    """Bronze stores no id; recompute the grain key from the raw strings."""
    return bronze.withColumn("transaction_id", grain_key(
        try_int("step"), F.col("type"), F.col("nameOrig"), F.col("nameDest"), try_money("amount")))


def trace_mart_cell(date_key: str, transaction_type: str, segment: str, fact: DataFrame,
                    dim_customer: DataFrame, bronze: DataFrame) -> DataFrame:
    """All raw bronze rows behind one mart cell (every loaded version).

    mart cell -> fact rows (day, type, customers of the segment) ->
    ``transaction_id`` -> bronze rows with the same recomputed key.  Both
    hops are semi joins, so no row is duplicated and nothing is collected.

    The key embeds ``step`` and ``type``, so a raw row can only match when
    its type is the cell's type (an equality pushed into the Parquet scan)
    and its step falls on the cell's day (24 steps of the event clock); both
    filters run before any hashing or shuffle and drop no matching row.
    """
    day = F.lit(date_key).cast("date")
    first_step = F.datediff(day, F.lit(EVENT_CLOCK_ANCHOR[:10]).cast("date")) * 24 + 1
    candidates = bronze.filter((F.col("type") == transaction_type)
                               & try_int("step").between(first_step, first_step + 23))
    customers = dim_customer.filter(F.col("segment") == segment).select(
        F.col("customer_key").alias("orig_customer_key"))
    ids = (fact.filter((F.col("date_key") == day) & (F.col("transaction_type") == transaction_type))
           .join(customers, "orig_customer_key", "left_semi").select("transaction_id"))
    return bronze_with_key(candidates).join(ids, "transaction_id", "left_semi")


def raw_ids_absent(df: DataFrame, bronze: DataFrame, columns=PII_COLUMNS) -> DataFrame:
    """Number of raw account ids that appear verbatim in any string column of
    ``df`` (must be 0 past the silver boundary)."""
    raw = bronze.select(F.explode(F.array(*columns)).alias("v")).filter("v <> ''").distinct()
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    values = df.select(F.explode(F.array(*texts)).alias("v")).filter("v IS NOT NULL").distinct()
    leaked = values.join(raw, "v", "left_semi")
    return leaked.agg(F.count(F.lit(1)).alias("raw_ids_found"))


def register_bronze(spark, bronze_path: str, privileged: bool = False,
                    view: str = "bronze_transactions_raw") -> str:
    """Expose bronze to SQL, masked unless ``privileged``.

    The view is registered over the masked frame, so no name in the session
    leads to the unmasked rows, and no session function that could later be
    redefined is involved.  Refuses when a PII column is missing.
    """
    read_masked(bronze_view(spark, bronze_path), privileged).createOrReplaceTempView(view)
    return view
