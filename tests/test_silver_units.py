"""Crafted-row logic tests: the contract mapping and latest-load dedup."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import silver
from ledgerline.sources.raw import RAW_COLUMNS

BASE = {"step": "1", "type": "PAYMENT", "amount": "100.00", "nameOrig": "C1", "oldbalanceOrg": "100",
        "newbalanceOrig": "0", "nameDest": "M1", "oldbalanceDest": "0", "newbalanceDest": "0",
        "isFraud": "0", "isFlaggedFraud": "0"}
BRONZE_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", _source_file string, _load_ts timestamp_ntz"
LOAD = datetime(2026, 7, 2)


def bronze_rows(spark, changes):
    rows = []
    for ch in changes:
        r = dict(BASE)
        r.update(ch)
        rows.append(tuple(r[c] for c in RAW_COLUMNS) + ("x", LOAD))
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def reasons(spark, changes):
    df = bronze_rows(spark, changes).withColumn("_i", F.monotonically_increasing_id())
    staged = silver.stage(df.drop("_i")).withColumn("_i", F.monotonically_increasing_id())
    return [r["_quarantine_reason"] for r in staged.orderBy("_i").collect()]


def test_contract_mapping_one_reason_each(spark):
    got = reasons(spark, [{}, {"nameDest": ""}, {"step": "0"}, {"amount": "abc"}, {"amount": "-5.00"},
                          {"oldbalanceOrg": "-1"}, {"nameOrig": "X1"}])
    assert got == [None, "null_account_key", "invalid_step", "unparseable_amount", "negative_amount",
                   "negative_balance", "unknown_actor_type"]


def test_contract_extra_coverage(spark):
    got = reasons(spark, [
        {"nameOrig": None, "nameDest": None},      # both ids NULL
        {"step": None},                            # NULL step
        {"step": "1.5"},                           # not an integer
        {"step": "0", "amount": "abc"},            # two breaches: first wins
        {"oldbalanceOrg": "n/a"},                  # unparseable balance passes (NULL -> 0)
        {"isFraud": "yes"},                        # unparseable flag: clean, NULL flag
        {"type": "REFUND"},                        # unknown type passes the contract
    ])
    assert got == ["null_account_key", "invalid_step", "invalid_step", "invalid_step", None, None, None]


def test_unparseable_flag_is_null_and_raw_ids_dropped(spark):
    staged = silver.stage(bronze_rows(spark, [{"isFraud": "yes"}]))
    row = staged.first()
    assert row["is_fraud"] is None
    assert "nameOrig" not in staged.columns and "nameDest" not in staged.columns
    assert row["orig_account_key"] == __import__("hashlib").sha256(b"C1").hexdigest()
    assert row["event_ts"] == datetime(2023, 1, 1, 0, 0)
    assert row["orig_account_type"] == "customer" and row["dest_account_type"] == "merchant"


STAGED_SCHEMA = (
    "transaction_id string, event_ts timestamp_ntz, step_num int, txn_type string, amount decimal(18,2), "
    "orig_account_key string, orig_account_type string, old_balance_orig decimal(18,2), "
    "new_balance_orig decimal(18,2), dest_account_key string, dest_account_type string, "
    "old_balance_dest decimal(18,2), new_balance_dest decimal(18,2), is_fraud boolean, "
    "is_flagged_fraud boolean, _source_file string, _load_ts timestamp_ntz, _quarantine_reason string")


def staged_row(tid, ts, step, typ, amt, orig, otype, ob, nb, dest, dtype, odb, ndb, load):
    return (tid, ts, step, typ, Decimal(amt), orig, otype, Decimal(ob), Decimal(nb), dest, dtype,
            Decimal(odb), Decimal(ndb), False, False, "x", load, None)


def test_dedup_keeps_latest_load(spark):
    rows = [
        staged_row("txn_a", datetime(2023, 1, 1), 1, "PAYMENT", "100.00", "o1", "customer", "100", "0", "d1",
                   "merchant", "0", "0", datetime(2026, 7, 2)),
        staged_row("txn_a", datetime(2023, 1, 1), 1, "PAYMENT", "999.00", "o1", "customer", "100", "0", "d1",
                   "merchant", "0", "0", datetime(2026, 7, 3)),
        staged_row("txn_b", datetime(2023, 1, 1, 1), 2, "CASH_OUT", "50.00", "o2", "customer", "50", "0", "d2",
                   "customer", "0", "50", datetime(2026, 7, 2)),
    ]
    out = silver.clean(spark.createDataFrame(rows, STAGED_SCHEMA)).orderBy("transaction_id").collect()
    assert [(r["transaction_id"], r["amount"], r["_load_ts"]) for r in out] == [
        ("txn_a", Decimal("999.00"), datetime(2026, 7, 3)),
        ("txn_b", Decimal("50.00"), datetime(2026, 7, 2))]


def test_dedup_tie_inside_batch_is_total_order(spark):
    t = datetime(2026, 7, 2)
    rows = [staged_row("k", datetime(2023, 1, 1), 1, "PAYMENT", "5.00", "o", "customer", "9", nb, "d",
                       "merchant", "0", "0", t) for nb in ("3", "1", "2")]
    df = spark.createDataFrame(rows, STAGED_SCHEMA)
    for parts in (1, 3):
        got = silver.clean(df.repartition(parts)).first()["new_balance_orig"]
        assert got == Decimal("1.00")  # smallest balance wins among equal loads


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_batch_order_does_not_change_silver(spark, order):
    from tests.conftest import SF001
    from ledgerline.sources import fixture
    b = [fixture.batch(spark, SF001, i) for i in order]
    clean = silver.clean(silver.stage(b[0].unionByName(b[1])))
    agg = clean.agg(F.count("*"), F.sum("amount"), F.sum("new_balance_orig")).first()
    assert tuple(agg) == (821, Decimal("41036.02"), Decimal("3791713.68"))
