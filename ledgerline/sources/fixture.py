"""Raw payment batches derived from the driver tables (``events`` joined to
``customer``), so every job runs on data that grows with the scale factor.

The mapping deliberately injects every contract breach, late arrivals and
replayed corrections (see FIXTURES.md section 3).  Batch 0 is the first load;
batch 1 carries the late rows plus replays whose ``newbalanceOrig`` was
corrected, so the later load must win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import MONEY
from ledgerline.sources.raw import RAW_COLUMNS, stamp

# event_type -> transaction type.
EVENT_TYPE_TO_TXN = (
    ("click", "PAYMENT"),
    ("view", "CASH_OUT"),
    ("purchase", "TRANSFER"),
    ("signup", "CASH_IN"),
    ("error", "DEBIT"),
)

# Batch names and arrival stamps.
BATCH_0 = ("events/batch-0", "2024-02-01 00:00:00")
BATCH_1 = ("events/batch-1", "2024-02-02 00:00:00")

# Origin of the fixture step counter.
STEP_ORIGIN = "2024-01-01 00:00:00"


def _txn_type(event_type: Column) -> Column:
    expr = None
    for ev, txn in EVENT_TYPE_TO_TXN:
        expr = F.when(event_type == ev, txn) if expr is None else expr.when(event_type == ev, txn)
    return expr


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw, all-string row per event (batch membership columns kept)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value")
    cu = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_acctbal")
    j = ev.join(cu, ev["user_id"] == cu["c_custkey"], "inner")

    eid, uid = F.col("event_id"), F.col("user_id")
    amt = F.col("value").cast(MONEY)
    bal = F.col("c_acctbal").cast(MONEY)
    ttype = _txn_type(F.col("event_type"))
    hours = F.timestamp_diff("HOUR", F.lit(STEP_ORIGIN).cast("timestamp_ntz"), F.col("ts"))
    uid_s = uid.cast("string")
    transfer_like = ttype.isin("TRANSFER", "CASH_OUT")
    return j.select(
        eid.alias("event_id"),
        F.when(eid % 103 == 1, F.lit("0")).otherwise((hours + 1).cast("string")).alias("step"),
        ttype.alias("type"),
        F.when(eid % 107 == 2, F.lit("abc"))
         .when(eid % 109 == 3, F.concat(F.lit("-"), amt.cast("string")))
         .otherwise(amt.cast("string")).alias("amount"),
        F.when(eid % 113 == 4, F.concat(F.lit("X"), uid_s))
         .when(eid % 50 == 0, F.concat(F.lit("M"), uid_s))
         .otherwise(F.concat(F.lit("C"), uid_s)).alias("nameOrig"),
        bal.cast("string").alias("oldbalanceOrg"),
        F.when(bal < amt, bal).otherwise(bal - amt).cast("string").alias("newbalanceOrig"),
        F.when(eid % 101 == 5, F.lit(""))
         .when(transfer_like, F.concat(F.lit("C"), ((uid * 7 + eid) % 150).cast("string")))
         .otherwise(F.concat(F.lit("M"), (eid % 10).cast("string"))).alias("nameDest"),
        F.lit("0").alias("oldbalanceDest"),
        F.lit("0").alias("newbalanceDest"),
        F.when(transfer_like & (eid % 97 == 0), F.lit("1")).otherwise(F.lit("0")).alias("isFraud"),
        F.when((ttype == "TRANSFER") & (amt > 300), F.lit("1")).otherwise(F.lit("0"))
         .alias("isFlaggedFraud"),
    )


def batch(spark: SparkSession, sf_dir: str, which: int, stamped: bool = True) -> DataFrame:
    """Raw batch 0 or 1 (11 string columns, plus the stamp when ``stamped``)."""
    rows = raw_rows(spark, sf_dir)
    eid = F.col("event_id")
    if which == 0:
        out, (name, ts) = rows.filter(eid % 31 != 7), BATCH_0
    elif which == 1:
        out, (name, ts) = rows.filter((eid % 31 == 7) | (eid % 20 == 0)), BATCH_1
        out = out.withColumn("newbalanceOrig", F.col("oldbalanceOrg"))
    else:
        raise ValueError(f"fixture has batches 0 and 1, not {which}")
    out = out.select(*RAW_COLUMNS)
    return stamp(out, name, ts) if stamped else out


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stamped batches, as the bronze table holds them."""
    return batch(spark, sf_dir, 0).unionByName(batch(spark, sf_dir, 1))


def volume_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a wide-date fact stand-in for the rollup and layout jobs.

    ``transaction_id`` = sha2 of the row's physical identity (file name and
    Parquet row index, both produced by the scan itself): deterministic,
    unique, and free -- no aggregate or shuffle is needed to number rows,
    and (``l_orderkey``, ``l_linenumber``) is not a key in this data.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rid = F.concat_ws("|", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))
    return li.select(
        F.sha2(rid, 256).alias("transaction_id"),
        F.to_date("l_shipdate").alias("date_key"),
        F.col("l_returnflag").alias("transaction_type"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        (F.col("l_discount") == F.lit(0.1)).alias("is_fraud"),
    )
