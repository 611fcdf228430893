"""Crash recovery: a run that died between writing data and recording the
commit is repaired by simply running again."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.upsert import commit_watermark, high_water_mark, upsert
from ledgerline.plans import gold, registry
from ledgerline.sources import bronze as bronze_table
from ledgerline.sources import fixture
from ledgerline.sources.raw import stamp
from tests.conftest import SF001


def test_partial_bronze_batch_is_relanded_not_duplicated(spark, tmp):
    path = os.path.join(tmp, "bronze")
    name, ts = fixture.BATCH_0
    full = fixture.batch(spark, SF001, 0, stamped=False)
    # a crashed run: the ledger was created, part of the batch's files
    # landed, the run died before the batch's ledger row
    bronze_table.ensure_ledger(spark, path)
    stamp(full.limit(100), name, ts).write.mode("append").partitionBy("_source_file").parquet(path)
    assert not bronze_table.already_loaded(spark, path, name)
    n = bronze_table.ingest_batch(spark, path, name, lambda: full, ts)
    assert n == full.count()  # partial files replaced, not added to
    assert bronze_table.already_loaded(spark, path, name)
    led = bronze_table.read_ledger(spark, path).collect()
    assert [(r["_source_file"], r["rows"]) for r in led] == [(name, full.count())]
    # and a second call is a no-op
    assert bronze_table.ingest_batch(spark, path, name, lambda: full, ts) == n


def test_fact_recovers_from_half_committed_upsert(spark, tmp):
    bpath, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    bronze_table.ingest_batch(spark, bpath, fixture.BATCH_0[0],
                              lambda: fixture.batch(spark, SF001, 0, stamped=False), fixture.BATCH_0[1])
    registry.run(spark, bronze_table.bronze_view(spark, bpath), root)
    fact_path = os.path.join(root, "gold", "fact_transaction")
    mark = high_water_mark(spark, fact_path)
    bronze_table.ingest_batch(spark, bpath, fixture.BATCH_1[0],
                              lambda: fixture.batch(spark, SF001, 1, stamped=False), fixture.BATCH_1[1])
    # a crashed run: only the first days of the increment were overwritten and
    # the watermark was never committed
    from ledgerline.catalog import chain_from
    c = chain_from(bronze_table.bronze_view(spark, bpath))
    inc = gold.fact(c.clean, since=mark)
    upsert(spark, fact_path, inc.filter(F.col("date_key") < F.lit("2023-01-10").cast("date")),
           check_unique=False)
    assert spark.read.parquet(fact_path).agg(F.max("_load_ts")).first()[0] > mark  # data advanced ...
    assert high_water_mark(spark, fact_path) == mark                               # ... the mark did not
    res = registry.run(spark, bronze_table.bronze_view(spark, bpath), root)
    got = sorted(tuple(r) for r in res.tables["gold.fact_transaction"].select(*gold.FACT_COLUMNS).collect())
    want = sorted(tuple(r) for r in c.fact.select(*gold.FACT_COLUMNS).collect())
    assert got == want and len(got) == 821


def test_watermark_is_monotonic_and_hidden_from_reads(spark, tmp):
    from datetime import datetime
    path = os.path.join(tmp, "t")
    spark.createDataFrame([("a", datetime(2023, 1, 1).date(), datetime(2024, 1, 1))],
                          "transaction_id string, date_key date, _load_ts timestamp_ntz") \
        .write.partitionBy("date_key").parquet(path)
    commit_watermark(spark, path, datetime(2024, 1, 5))
    commit_watermark(spark, path, datetime(2024, 1, 3))
    assert high_water_mark(spark, path) == datetime(2024, 1, 5)
    assert spark.read.parquet(path).columns == ["transaction_id", "_load_ts", "date_key"]


@pytest.mark.parametrize("buckets", [None, 4])
def test_incremental_silver_equals_full_rebuild(spark, tmp, buckets):
    """Two runs that each process only the new batch give the same silver,
    quarantine, audit, fact and mart as one full rebuild over both (with and
    without key buckets under the date folders)."""
    bpath, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    for which, (name, ts) in ((0, fixture.BATCH_0), (1, fixture.BATCH_1)):
        bronze_table.ingest_batch(spark, bpath, name,
                                  lambda w=which: fixture.batch(spark, SF001, w, stamped=False), ts)
        inc = registry.run(spark, bronze_table.bronze_view(spark, bpath), root,
                           incremental_silver=True, bronze_path=bpath, silver_buckets=buckets,
                           fact_buckets=buckets)
    assert all(r["status"] == "pass" for r in inc.checks) and len(inc.checks) == 49
    full = registry.run(spark, bronze_table.bronze_view(spark, bpath), os.path.join(tmp, "full"))

    def rows(res, name):
        return sorted(tuple(r) for r in res.tables[name].collect())
    for name in ("silver.transactions", "silver.transactions_quarantine",
                 "silver.audit_silver_reconciliation", "gold.fact_transaction",
                 "gold.mart_daily_settled_volume", "gold.dim_customer"):
        assert rows(inc, name) == rows(full, name), name
    # a third run finds no new batch and changes nothing
    again = registry.run(spark, bronze_table.bronze_view(spark, bpath), root,
                         incremental_silver=True, bronze_path=bpath, silver_buckets=buckets,
                         fact_buckets=buckets)
    assert rows(again, "silver.transactions") == rows(full, "silver.transactions")


def test_full_and_incremental_runs_share_a_root(spark, tmp):
    """Full, incremental, full, incremental on one root, a batch in between:
    each run gives the rows of a full rebuild; rewrites stay clustered."""
    import glob
    bpath, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")

    def land(which, name, ts):
        bronze_table.ingest_batch(spark, bpath, name, lambda: fixture.batch(spark, SF001, which, stamped=False), ts)

    def run(incremental):
        res = registry.run(spark, bronze_table.bronze_view(spark, bpath), root, incremental_silver=incremental,
                           bronze_path=bpath)
        return sorted(tuple(r) for r in res.tables["silver.transactions"].collect())

    land(0, *fixture.BATCH_0)
    first = run(False)
    assert run(True) == first
    land(1, *fixture.BATCH_1)
    second = run(True)
    assert second != first and run(False) == second and run(True) == second
    days = glob.glob(root + "/gold/fact_transaction/date_key=*")
    files = glob.glob(root + "/gold/fact_transaction/date_key=*/*.parquet")
    assert days and len(files) <= 2 * len(days)


def test_incremental_silver_with_no_quarantined_rows(spark, tmp):
    """A first batch with only clean rows: the quarantine table is empty but
    readable, and every check and the gate pass."""
    from datetime import datetime as _dt
    from ledgerline.sources.raw import RAW_COLUMNS
    bpath, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    row = {"step": "1", "type": "PAYMENT", "amount": "10.00", "nameOrig": "C1", "oldbalanceOrg": "100",
           "newbalanceOrig": "90", "nameDest": "M1", "oldbalanceDest": "0", "newbalanceDest": "0",
           "isFraud": "0", "isFlaggedFraud": "0"}
    df = spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS)], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    bronze_table.ingest_batch(spark, bpath, "clean-only", df, _dt(2024, 2, 1))
    res = registry.run(spark, bronze_table.bronze_view(spark, bpath), root,
                       incremental_silver=True, bronze_path=bpath)
    assert res.tables["silver.transactions_quarantine"].count() == 0
    assert res.tables["silver.transactions"].count() == 1
    assert tuple(res.gate[0]) == (True, True, True)


def test_incremental_silver_out_of_order_batches(spark, tmp):
    """The later-stamped batch is processed first; the earlier batch arrives
    afterwards.  Latest load still wins: silver equals the full rebuild."""
    bpath, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    for which, (name, ts) in ((1, fixture.BATCH_1), (0, fixture.BATCH_0)):
        bronze_table.ingest_batch(spark, bpath, name,
                                  lambda w=which: fixture.batch(spark, SF001, w, stamped=False), ts)
        from ledgerline.plans import incremental
        incremental.update_silver(spark, bpath, root)
    from ledgerline.catalog import chain_from
    want = sorted(tuple(r) for r in chain_from(bronze_table.bronze_view(spark, bpath)).clean.collect())
    got = sorted(tuple(r) for r in incremental.read_silver(spark, root).collect())
    assert got == want and len(got) == 821


def test_silver_folders_follow_the_rows_of_a_day(spark, tmp, monkeypatch):
    """A small table has a folder a year; when its days grow it is laid out
    anew by month, then by day, and always equals a full rebuild."""
    from ledgerline.catalog import chain_from
    from ledgerline.plans import incremental

    assert [incremental.unit_for(n) for n in (1, 600, 700, 8000, 9000, 249_999, 250_000)] == [
        "year", "year", "year", "year", "month", "month", "day"]
    bpath, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    table = incremental.paths(root)["transactions"]
    full = fixture.batch(spark, SF001, 0, stamped=False)
    # 821 rows over some months: the limits are those of a table that has grown
    for i, (rows_a_folder, unit) in enumerate(((10**6, "year"), (100, "month"), (2, "day"), (10**6, "day"))):
        monkeypatch.setattr(incremental, "FOLDER_ROWS", rows_a_folder)
        part = full.filter(F.pmod(F.crc32(F.concat_ws("|", "nameOrig", "step").cast("binary")), F.lit(4)) == i)
        bronze_table.ingest_batch(spark, bpath, f"part-{i}", part, f"2024-02-0{i + 1} 00:00:00")
        incremental.update_silver(spark, bpath, root)
        assert incremental.table_unit(spark, table) == unit
        want = sorted(tuple(r) for r in chain_from(bronze_table.bronze_view(spark, bpath)).clean.collect())
        assert sorted(tuple(r) for r in incremental.read_silver(spark, root).collect()) == want
        audit = incremental.audit(spark, root).first()
        assert audit["rows_tie"] and audit["amount_tie"] and audit["clean_rows"] == len(want)


def test_keys_move_as_bytes_and_come_back(spark, tmp):
    from pyspark.sql import functions as F

    from ledgerline.operators import upsert

    rows = [("ab" * 32, "x", 1), ("AB" * 32, None, 1), ("abc", "", 2), (None, "00", 2), ("", "zz", 3), ("é", "0f", None)]
    df = spark.createDataFrame(rows, "id string, note string, day int")
    moved = upsert._clustered(df, ["day"])
    assert moved.columns == df.columns and sorted(map(str, moved.collect())) == sorted(map(str, df.collect()))
    assert "unhex" in moved._jdf.queryExecution().optimizedPlan().toString()
    assert upsert.repeated(df, "id").isEmpty()
    twice = upsert.repeated(df.unionByName(df.filter(F.col("id").isNull() | (F.col("id") == "abc"))), "id")
    assert sorted(map(str, map(tuple, twice.collect()))) == ["('abc', 2)", "(None, 2)"]
    upsert.upsert(spark, f"{tmp}/t", df, "id", "day")
    assert sorted(map(str, spark.read.parquet(f"{tmp}/t").select(*df.columns).collect())) == sorted(map(str, df.collect()))
