"""Gold: the star schema (fact + four dimensions) and the daily mart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import as_ntz
from ledgerline.operators.rank import ntile_global

FACT_COLUMNS = (
    "transaction_id", "date_key", "transaction_type", "orig_account_key", "dest_account_key",
    "orig_customer_key", "amount", "is_fraud", "is_flagged_fraud", "event_ts", "_load_ts",
)

# The transaction-type dimension (type, description, flow direction).
TRANSACTION_TYPES = (
    ("CASH_IN", "Customer deposits cash into an account via a merchant.", "inflow"),
    ("CASH_OUT", "Customer withdraws cash from an account via a merchant.", "outflow"),
    ("TRANSFER", "Funds moved between customer accounts.", "transfer"),
    ("PAYMENT", "Customer pays a merchant for goods or services.", "outflow"),
    ("DEBIT", "Funds sent from an account to a bank.", "outflow"),
)

# Ntile bucket -> segment name.
SEGMENTS = ((3, "high"), (2, "medium"), (1, "low"))

MONEY_SUM = "decimal(28,2)"


def fact(clean: DataFrame, since: datetime | str | None = None) -> DataFrame:
    """One row per transaction; ``since`` keeps rows loaded strictly later."""
    src = clean if since is None else clean.filter(F.col("_load_ts") > as_ntz(since))
    return src.select(
        "transaction_id",
        F.to_date("event_ts").alias("date_key"),
        F.col("txn_type").alias("transaction_type"),
        "orig_account_key", "dest_account_key",
        F.when(F.col("orig_account_type") == "customer", F.col("orig_account_key"))
        .alias("orig_customer_key"),
        "amount", "is_fraud", "is_flagged_fraud", "event_ts", "_load_ts",
    )


def account_profile(clean: DataFrame) -> DataFrame:
    """Per account: type, activity window, appearances, originated volume.

    One scan: each transaction is exploded into its two appearances
    (originator, destination) and a single aggregate produces both the account
    dimension and the customer volume profile -- no UNION re-scan and no join
    between them.  The aggregate is partial, so a hot account collapses on the
    map side.
    """
    appear = clean.select(
        F.explode(F.array(
            F.struct(F.col("orig_account_key").alias("k"), F.col("orig_account_type").alias("t"),
                     F.col("event_ts").alias("ts"), F.lit(True).alias("o"),
                     F.col("amount").alias("a")),
            F.struct(F.col("dest_account_key").alias("k"), F.col("dest_account_type").alias("t"),
                     F.col("event_ts").alias("ts"), F.lit(False).alias("o"),
                     F.lit(None).cast("decimal(18,2)").alias("a")),
        )).alias("x"))
    originated = F.col("x.o") & (F.col("x.t") == "customer")
    return appear.groupBy(F.col("x.k").alias("account_key")).agg(
        F.bool_or(F.col("x.t") == "merchant").alias("_any_merchant"),
        F.min("x.ts").alias("first_seen_ts"),
        F.max("x.ts").alias("last_seen_ts"),
        F.count(F.lit(1)).alias("appearance_count"),
        F.sum(F.when(originated, F.col("x.a"))).alias("_orig_amount"),
        F.count_if(originated).alias("_orig_count"),
    ).withColumn("account_type", F.when(F.col("_any_merchant"), "merchant").otherwise("customer"))


def dim_account(clean_or_profile: DataFrame) -> DataFrame:
    prof = clean_or_profile if "_any_merchant" in clean_or_profile.columns \
        else account_profile(clean_or_profile)
    return prof.select("account_key", "account_type", "first_seen_ts", "last_seen_ts",
                       "appearance_count")


def customer_originated(clean: DataFrame) -> DataFrame:
    """Originated volume per customer originator (A3)."""
    return (clean.filter(F.col("orig_account_type") == "customer")
            .groupBy(F.col("orig_account_key").alias("customer_key"))
            .agg(F.sum("amount").cast(MONEY_SUM).alias("total_originated_amount"),
                 F.count(F.lit(1)).alias("originated_txn_count")))


def dim_customer(clean_or_profile: DataFrame) -> DataFrame:
    """Customer accounts + originated volume + a tertile segment.

    The segment is ``ntile(3)`` over all customers by volume (ties broken by
    the key); it is computed by the distributed global rank, not a
    single-partition window.
    """
    prof = clean_or_profile if "_any_merchant" in clean_or_profile.columns \
        else account_profile(clean_or_profile)
    customers = prof.filter(F.col("account_type") == "customer").select(
        F.col("account_key").alias("customer_key"), "first_seen_ts", "last_seen_ts",
        F.coalesce(F.col("_orig_amount"), F.lit(0)).cast(MONEY_SUM).alias("total_originated_amount"),
        F.col("_orig_count").alias("originated_txn_count"))
    tiled = ntile_global(customers, 3, [F.col("total_originated_amount"), F.col("customer_key")],
                         "_tile")
    seg = None
    for tile, name in SEGMENTS[:-1]:
        seg = F.when(F.col("_tile") == tile, name) if seg is None else seg.when(F.col("_tile") == tile, name)
    seg = seg.otherwise(SEGMENTS[-1][1])
    return tiled.select("customer_key", "first_seen_ts", "last_seen_ts", "total_originated_amount",
                        "originated_txn_count", seg.alias("segment"))


def dim_date(clean: DataFrame) -> DataFrame:
    """Contiguous daily spine over the event window (gap days included)."""
    bounds = clean.agg(F.to_date(F.min("event_ts")).alias("lo"), F.to_date(F.max("event_ts")).alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
    d = F.col("date_key")
    return spine.select(
        d, F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("weekday_name"), F.dayofweek(d).alias("weekday_num"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def dim_transaction_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TRANSACTION_TYPES),
                                 "transaction_type string, description string, flow_direction string")


def mart(fact_df: DataFrame, dim_date_df: DataFrame, dim_customer_df: DataFrame) -> DataFrame:
    """Daily settled volume by day x type x customer segment.

    Plan: the narrow fact projection (5 columns) is semi-joined with the
    calendar (small, so adaptive execution broadcasts it by its measured
    size), then inner-joined with the customer
    segment on the customer key -- one shuffle of the fact.  The dimension
    side is unique per key, so a customer holding a third of all rows only
    makes the fact side of one partition large, which AQE's skew-join split
    divides across tasks (the one matching dimension row is replicated).
    Merchant originators have no customer key and drop out here, as in an
    inner join.  The final aggregate is partial on the map side and its
    output is the mart grain, so the last shuffle is tiny.
    """
    f = fact_df.filter(F.col("orig_customer_key").isNotNull()).select(
        "date_key", "transaction_type", "orig_customer_key", "amount", "is_fraud")
    days = dim_date_df.select("date_key")
    seg = dim_customer_df.select(F.col("customer_key").alias("orig_customer_key"), "segment")
    j = f.join(days, "date_key", "left_semi").join(seg, "orig_customer_key", "inner")
    agg = j.groupBy("date_key", "transaction_type", F.col("segment").alias("customer_segment")).agg(
        F.sum("amount").cast(MONEY_SUM).alias("settled_amount"),
        F.count(F.lit(1)).cast("bigint").alias("transaction_count"),
        F.count_if(F.col("is_fraud")).cast("bigint").alias("fraud_count"))
    key = F.md5(F.concat_ws("|", F.col("date_key").cast("string"), F.col("transaction_type"),
                            F.col("customer_segment")))
    return agg.select(key.alias("mart_key"), "date_key", "transaction_type", "customer_segment",
                      "settled_amount", "transaction_count", "fraud_count")
