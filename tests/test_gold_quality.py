"""Runner with the 49 data tests, the gate, upsert semantics and properties."""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.catalog import chain
from ledgerline.operators import quality
from ledgerline.operators.upsert import high_water_mark, merge_latest, upsert
from ledgerline.plans import gold, registry, silver
from ledgerline.sources import fixture
from tests.conftest import SF001


def test_there_are_49_data_tests():
    assert registry.count_checks() == 49


def test_full_run_passes_all_checks_and_gate(spark, tmp):
    res = registry.run(spark, fixture.bronze(spark, SF001), os.path.join(tmp, "lake"))
    assert len(res.checks) == 49 and all(r["status"] == "pass" for r in res.checks)
    assert tuple(res.gate[0]) == (True, True, True)
    mart = res.tables["gold.mart_daily_settled_volume"]
    agg = mart.agg(F.count("*"), F.sum("settled_amount"), F.sum("transaction_count"),
                   F.sum("fraud_count")).first()
    assert tuple(agg) == (149, Decimal("40107.69"), 805, 3)
    # second run: everything already loaded, incremental fact unchanged
    res2 = registry.run(spark, fixture.bronze(spark, SF001), os.path.join(tmp, "lake"))
    assert res2.tables["gold.fact_transaction"].count() == 821


def test_failing_check_stops_downstream(spark, tmp):
    bad = fixture.bronze(spark, SF001).withColumn(
        "type", F.when(F.col("step").endswith("7"), F.lit("REFUND")).otherwise(F.col("type")))
    with pytest.raises(quality.QualityError, match="silver.transactions"):
        registry.run(spark, bad, os.path.join(tmp, "lake"))
    # everything downstream of silver.transactions is absent; an independent
    # model (the static type dimension) may have been built concurrently
    for name in ("dim_date", "dim_account", "dim_customer", "fact_transaction",
                 "mart_daily_settled_volume"):
        assert not os.path.exists(os.path.join(tmp, "lake", "gold", name))


def test_gate_raises_on_empty_fact(spark):
    c = chain(spark, SF001)
    audit = silver.reconcile(c.staged, c.clean)
    with pytest.raises(Exception, match="fact_transaction is empty"):
        registry.gate(c.fact.limit(0), c.mart(), audit).collect()


def test_gate_raises_on_broken_tie(spark):
    c = chain(spark, SF001)
    audit = silver.reconcile(c.staged, c.clean).withColumn("rows_tie", F.lit(False))
    with pytest.raises(Exception, match="reconciliation identity"):
        registry.gate(c.fact, c.mart(), audit).collect()


def test_check_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (2, None), (3, "q"), (3, "q")],
                               "k int, v string")
    assert quality.unique(df, "k", "t").first()["failures"] == 2
    nn = {r["column_name"]: r["failures"] for r in quality.not_null(df, ["k", "v"], "t").collect()}
    assert nn == {"k": 1, "v": 1}
    # distinct bad values, NULL passes
    assert quality.accepted_values(df, "v", ["a", "b"], "t").first()["failures"] == 2
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert quality.relationships(df, "k", parent, "k", "t", "p").first()["failures"] == 2


def test_freshness_statuses(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 2),)], "ts timestamp_ntz")
    st = {a: quality.freshness(df, "ts", a, "t").first()["status"]
          for a in ("2024-02-10 00:00:00", "2024-03-15 00:00:00", "2024-06-15 00:00:00")}
    assert st == {"2024-02-10 00:00:00": "pass", "2024-03-15 00:00:00": "warn", "2024-06-15 00:00:00": "error"}


def test_reconciliation_identity_counts_and_amounts(spark):
    c = chain(spark, SF001)
    a = silver.reconcile(c.staged, c.clean).first()
    assert a["rows_tie"] and a["amount_tie"]
    assert a["bronze_rows"] == a["quarantine_rows"] + a["clean_rows"] + a["duplicates_removed"]
    # dedup only removes: amounts tie across the dedup step too
    dup_amount = c.eligible.agg(F.sum("amount")).first()[0] - c.clean.agg(F.sum("amount")).first()[0]
    assert a["clean_eligible_amount"] - a["clean_amount"] == dup_amount


def test_mart_is_fact_minus_unattributed(spark):
    c = chain(spark, SF001)
    fact_total = c.fact.agg(F.sum("amount")).first()[0]
    unattributed = c.fact.filter(F.col("orig_customer_key").isNull()).agg(F.sum("amount")).first()[0]
    mart_total = c.mart().agg(F.sum("settled_amount")).first()[0]
    assert mart_total == fact_total - unattributed
    assert c.fact.filter(F.col("orig_customer_key").isNull()).count() == 16


def test_partition_count_does_not_change_results(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        outs = []
        for p in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", p)
            m = chain(spark, SF001).mart()
            outs.append(sorted(tuple(r) for r in m.collect()))
        assert outs[0] == outs[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_upsert_update_insert_and_replay(spark, tmp):
    path = os.path.join(tmp, "fact")
    schema = "transaction_id string, date_key date, amount int, _load_ts timestamp_ntz"
    d1, d2 = datetime(2023, 1, 1).date(), datetime(2023, 1, 2).date()
    base = spark.createDataFrame([("a", d1, 1, datetime(2024, 1, 1)), ("b", d2, 2, datetime(2024, 1, 1))], schema)
    upsert(spark, path, base)
    upd = spark.createDataFrame([("a", d1, 10, datetime(2024, 1, 2)), ("c", d1, 3, datetime(2024, 1, 2))], schema)
    assert upsert(spark, path, upd) == 1  # only one partition touched
    upsert(spark, path, upd)              # replay: no duplicates
    got = {r["transaction_id"]: r["amount"] for r in spark.read.parquet(path).collect()}
    assert got == {"a": 10, "b": 2, "c": 3}
    assert high_water_mark(spark, path) == datetime(2024, 1, 2)
    with pytest.raises(ValueError, match="duplicate"):
        upsert(spark, path, upd.unionByName(upd))


def test_merge_latest_ignores_older_correction(spark, tmp):
    path = os.path.join(tmp, "fact2")
    schema = "transaction_id string, date_key date, amount int, _load_ts timestamp_ntz"
    d1 = datetime(2023, 1, 1).date()
    merge_latest(spark, path, spark.createDataFrame([("a", d1, 5, datetime(2024, 1, 3))], schema))
    merge_latest(spark, path, spark.createDataFrame([("a", d1, 1, datetime(2024, 1, 2))], schema))
    assert spark.read.parquet(path).first()["amount"] == 5


def test_high_water_mark_of_missing_table(spark, tmp):
    assert high_water_mark(spark, os.path.join(tmp, "nothing")) == datetime(1900, 1, 1)


def test_dim_date_spine_and_attributes(spark):
    d = gold.dim_date(chain(spark, SF001).clean).orderBy("date_key").collect()
    assert len(d) == 30 and str(d[0]["date_key"]) == "2023-01-01"
    first = d[0]
    assert (first["week_of_year"], first["weekday_num"], first["is_weekend"], first["weekday_name"],
            first["month_name"]) == (52, 1, True, "Sunday", "January")


def test_empty_silver_gives_empty_gold(spark):
    c = chain(spark, SF001)
    empty = c.clean.limit(0)
    assert gold.dim_date(empty).count() == 0
    assert gold.mart(gold.fact(empty), gold.dim_date(empty), gold.dim_customer(empty)).count() == 0


def test_batch_with_equal_load_ts_is_skipped_by_the_fact(spark, tmp):
    """T13: the high-water mark is strict, so a batch stamped with the current
    maximum `_load_ts` never reaches the incremental fact (documented)."""
    from ledgerline.sources import bronze as bronze_table
    path, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    ts0 = fixture.BATCH_0[1]
    bronze_table.ingest_batch(spark, path, "b0", lambda: fixture.batch(spark, SF001, 0, stamped=False), ts0)
    first = registry.run(spark, bronze_table.bronze_view(spark, path), root)
    n0 = first.tables["gold.fact_transaction"].count()
    # same stamp as the current maximum: lands in bronze and silver ...
    bronze_table.ingest_batch(spark, path, "b1", lambda: fixture.batch(spark, SF001, 1, stamped=False), ts0)
    second = registry.run(spark, bronze_table.bronze_view(spark, path), root)
    silver_rows = second.tables["silver.transactions"].count()
    # ... but not in the fact: new events of that batch are missing there
    assert second.tables["gold.fact_transaction"].count() == n0 < silver_rows


def test_empty_silver_run_stops_at_the_gate(spark, tmp):
    """Every row quarantined: silver, dims, fact and mart are empty but
    readable, all 49 checks pass, and the gate raises (fact is empty)."""
    import pytest as _pytest
    bad = fixture.bronze(spark, SF001).withColumn("nameDest", F.lit(""))
    with _pytest.raises(Exception, match="fact_transaction is empty"):
        registry.run(spark, bad, os.path.join(tmp, "lake"))


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp):
    path = os.path.join(tmp, "fact_b")
    schema = "transaction_id string, date_key date, amount int, _load_ts timestamp_ntz"
    d1, d2 = datetime(2023, 1, 1).date(), datetime(2023, 1, 2).date()
    base = [(f"t{i}", d1 if i % 2 else d2, i, datetime(2024, 1, 1)) for i in range(64)]
    upsert(spark, path, spark.createDataFrame(base, schema), buckets=8)
    folders = sorted(p for p in os.listdir(os.path.join(path, "date_key=2023-01-01")))
    assert folders and all(f.startswith("_bucket_of_8=") for f in folders)

    def files():
        out = {}
        for root, _, names in os.walk(path):
            for n in names:
                if n.endswith(".parquet"):
                    out[os.path.join(root, n)] = os.path.getmtime(os.path.join(root, n))
        return out
    before = files()
    upd = spark.createDataFrame([("t1", d1, 100, datetime(2024, 1, 2)), ("new", d2, 7, datetime(2024, 1, 2))],
                                schema)
    rewritten = upsert(spark, path, upd, buckets=2)   # the table's own layout (8) wins
    assert rewritten <= 2
    after = files()

    def by_folder(snapshot):
        out = {}
        for f, t in snapshot.items():
            out.setdefault(os.path.dirname(f), set()).add((os.path.basename(f), t))
        return out
    b, a = by_folder(before), by_folder(after)
    changed = [d for d in set(b) | set(a) if b.get(d) != a.get(d)]
    assert 1 <= len(changed) <= 2  # only the touched (date, bucket) folders were rewritten
    got = {r["transaction_id"]: r["amount"] for r in spark.read.parquet(path).collect()}
    assert got["t1"] == 100 and got["new"] == 7 and len(got) == 65
    upsert(spark, path, upd)                          # replay: idempotent
    assert spark.read.parquet(path).count() == 65


def test_registry_with_bucketed_fact_matches(spark, tmp):
    res = registry.run(spark, fixture.bronze(spark, SF001), os.path.join(tmp, "lake"), fact_buckets=4)
    assert all(r["status"] == "pass" for r in res.checks)
    want = sorted(tuple(r) for r in chain(spark, SF001).fact.select(*gold.FACT_COLUMNS).collect())
    got = sorted(tuple(r) for r in res.tables["gold.fact_transaction"].select(*gold.FACT_COLUMNS).collect())
    assert got == want
    assert any(c.startswith("_bucket_of_4") for c in
               spark.read.parquet(os.path.join(tmp, "lake", "gold", "fact_transaction")).columns)


def test_bucketed_merge_latest_keeps_newest(spark, tmp):
    path = os.path.join(tmp, "silver_b")
    schema = "transaction_id string, date_key date, amount int, _load_ts timestamp_ntz"
    d1 = datetime(2023, 1, 1).date()
    rows = [(f"t{i}", d1, i, datetime(2024, 1, 3)) for i in range(20)]
    merge_latest(spark, path, spark.createDataFrame(rows, schema), buckets=4)
    late_old = spark.createDataFrame([("t3", d1, -1, datetime(2024, 1, 2)), ("t99", d1, 99, datetime(2024, 1, 2))],
                                     schema)
    merge_latest(spark, path, late_old, buckets=4)
    got = {r["transaction_id"]: r["amount"] for r in spark.read.parquet(path).collect()}
    assert got["t3"] == 3 and got["t99"] == 99 and len(got) == 21
