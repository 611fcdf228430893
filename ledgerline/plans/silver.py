"""Silver: typed + tokenised + validated staging, clean (deduplicated),
quarantine and the reconciliation audit.

``stage`` is the single projection that derives everything silver needs;
``clean`` and ``quarantine`` are two filters of it and ``reconcile`` proves,
by count and by amount, that every bronze row is accounted for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    actor_type, event_clock, flag, grain_key, tokenise, try_int, try_money,
)
from ledgerline.functions.contract import classify, default_rules
from ledgerline.operators.dedup import latest_by

# Silver column order (the 17 clean columns, then the reason).
SILVER_COLUMNS = (
    "transaction_id", "event_ts", "step_num", "txn_type", "amount",
    "orig_account_key", "orig_account_type", "old_balance_orig", "new_balance_orig",
    "dest_account_key", "dest_account_type", "old_balance_dest", "new_balance_dest",
    "is_fraud", "is_flagged_fraud", "_source_file", "_load_ts",
)
STAGED_COLUMNS = SILVER_COLUMNS + ("_quarantine_reason",)

# Latest load wins; the rest makes the order total (see operators.dedup).
DEDUP_ORDER = (
    ("_load_ts", "desc"), ("_source_file", "desc"), ("event_ts", "asc"),
    ("old_balance_orig", "asc"), ("new_balance_orig", "asc"),
    ("old_balance_dest", "asc"), ("new_balance_dest", "asc"),
    ("is_fraud", "asc"), ("is_flagged_fraud", "asc"),
)


def stage(bronze: DataFrame, secret: str | None = None) -> DataFrame:
    """Bronze (all strings) -> 18 typed columns; raw ids never leave this step."""
    typed = bronze.select(
        F.col("nameOrig"), F.col("nameDest"),
        F.col("type").alias("txn_type"),
        try_int("step").alias("step_num"),
        try_money("amount").alias("amount"),
        try_money("oldbalanceOrg").alias("old_balance_orig"),
        try_money("newbalanceOrig").alias("new_balance_orig"),
        try_money("oldbalanceDest").alias("old_balance_dest"),
        try_money("newbalanceDest").alias("new_balance_dest"),
        flag("isFraud").alias("is_fraud"),
        flag("isFlaggedFraud").alias("is_flagged_fraud"),
        F.col("_source_file"), F.col("_load_ts"),
    )
    orig, dest = F.col("nameOrig"), F.col("nameDest")
    rules = default_rules(orig, dest, F.col("step_num"), F.col("amount"),
                          [F.col("old_balance_orig"), F.col("new_balance_orig"),
                           F.col("old_balance_dest"), F.col("new_balance_dest")])
    return typed.select(
        grain_key(F.col("step_num"), F.col("txn_type"), orig, dest, F.col("amount"))
        .alias("transaction_id"),
        event_clock("step_num").alias("event_ts"),
        "step_num", "txn_type", "amount",
        tokenise(orig, secret).alias("orig_account_key"),
        actor_type(orig).alias("orig_account_type"),
        "old_balance_orig", "new_balance_orig",
        tokenise(dest, secret).alias("dest_account_key"),
        actor_type(dest).alias("dest_account_type"),
        "old_balance_dest", "new_balance_dest",
        "is_fraud", "is_flagged_fraud", "_source_file", "_load_ts",
        classify(rules).alias("_quarantine_reason"),
    )


def clean_eligible(staged: DataFrame) -> DataFrame:
    """Contract-passing rows before de-duplication."""
    return staged.filter(F.col("_quarantine_reason").isNull()).select(*SILVER_COLUMNS)


def clean(staged: DataFrame) -> DataFrame:
    """One row per ``transaction_id``: the latest load wins."""
    return latest_by(clean_eligible(staged), "transaction_id", DEDUP_ORDER)


def quarantine(staged: DataFrame) -> DataFrame:
    """Every contract-failing row with its reason; never de-duplicated."""
    return staged.filter(F.col("_quarantine_reason").isNotNull()).select(*STAGED_COLUMNS)


def reconcile(staged: DataFrame, clean_df: DataFrame) -> DataFrame:
    """One-row audit: bronze = quarantine + clean_eligible, by rows and amount.

    Bronze's parsed amount is the staged ``amount`` (the same ``try_cast``),
    so one aggregate over (staged UNION ALL clean) yields every figure -- no
    join, one pass per input.
    """
    money = "decimal(28,2)"
    tagged = staged.select(F.lit(0).alias("_part"), "amount", "_quarantine_reason") \
        .unionByName(clean_df.select(F.lit(1).alias("_part"), "amount",
                                     F.lit(None).cast("string").alias("_quarantine_reason")))
    is_stg, is_cln = F.col("_part") == 0, F.col("_part") == 1
    bad = is_stg & F.col("_quarantine_reason").isNotNull()
    good = is_stg & F.col("_quarantine_reason").isNull()
    a = tagged.agg(
        F.count_if(is_stg).alias("bronze_rows"),
        F.count_if(bad).alias("quarantine_rows"),
        F.count_if(good).alias("clean_eligible_rows"),
        F.count_if(is_cln).alias("clean_rows"),
        F.sum(F.when(is_stg, F.col("amount"))).cast(money).alias("bronze_amount"),
        F.sum(F.when(bad, F.col("amount"))).cast(money).alias("quarantine_amount"),
        F.sum(F.when(good, F.col("amount"))).cast(money).alias("clean_eligible_amount"),
        F.sum(F.when(is_cln, F.col("amount"))).cast(money).alias("clean_amount"),
    )
    zero = F.lit(0).cast(money)
    return a.select(
        "bronze_rows", "quarantine_rows", "clean_eligible_rows", "clean_rows",
        (F.col("clean_eligible_rows") - F.col("clean_rows")).alias("duplicates_removed"),
        (F.col("bronze_rows") == F.col("quarantine_rows") + F.col("clean_eligible_rows"))
        .alias("rows_tie"),
        "bronze_amount", "quarantine_amount", "clean_eligible_amount", "clean_amount",
        (F.coalesce(F.col("bronze_amount"), zero)
         == F.coalesce(F.col("quarantine_amount"), zero)
         + F.coalesce(F.col("clean_eligible_amount"), zero)).alias("amount_tie"),
    )


def reconciliation_failures(audit: DataFrame) -> DataFrame:
    """The audit row when either identity breaks; empty means green."""
    return audit.filter(~F.col("rows_tie") | ~F.col("amount_tie"))
