"""Masking, contract on masked reads, tracing, lineage and file layout."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.catalog import chain
from ledgerline.functions.masking import mask_account, mask_columns, register_sql_mask
from ledgerline.operators import layout
from ledgerline.plans import governance, lineage, registry
from ledgerline.plans.rollup import rollup
from ledgerline.sources import fixture
from tests.conftest import SF001


def test_mask_values(spark):
    df = spark.createDataFrame([("C123456",), ("C1",), (None,), ("",)], "v string")
    got = [r[0] for r in df.select(mask_account("v")).collect()]
    assert got == ["***3456", "***C1", None, "***"]  # short ids leak whole: documented
    assert [r[0] for r in df.select(mask_account("v", True)).collect()] == ["C123456", "C1", None, ""]


def test_mask_refuses_missing_column(spark):
    with pytest.raises(ValueError):
        mask_columns(spark.createDataFrame([("a",)], "x string"), ["nameOrig"])


def test_sql_mask_function(spark):
    register_sql_mask(spark, "mask_account_t")
    assert spark.sql("SELECT mask_account_t('C987654')").first()[0] == "***7654"


def test_masked_read_never_yields_clean_rows(spark):
    out = {r["_quarantine_reason"]: r["rows"] for r in
           governance.masked_contract(fixture.bronze(spark, SF001)).collect()}
    assert None not in out
    assert out["unknown_actor_type"] > 800


def test_trace_finds_every_loaded_version(spark):
    c = chain(spark, SF001)
    cell = c.mart().orderBy(F.col("transaction_count").desc(), "mart_key").first()
    traced = governance.trace_mart_cell(str(cell["date_key"]), cell["transaction_type"],
                                        cell["customer_segment"], c.fact, c.dim_customer(), c.bronze)
    assert traced.select("transaction_id").distinct().count() == cell["transaction_count"]
    assert traced.count() >= cell["transaction_count"]


def test_no_raw_ids_past_silver(spark):
    c = chain(spark, SF001)
    assert governance.raw_ids_absent(c.clean, c.bronze).first()[0] == 0


def test_lineage_edges_and_closure(spark):
    e = lineage.edges(spark)
    tables = {r[0] for r in e.select("table_name").distinct().collect()}
    assert len(tables) == 11 and "silver.audit_silver_reconciliation" in tables
    up = {r[0] for r in lineage.upstream(e, "gold.mart_daily_settled_volume").collect()}
    assert up == {"gold.fact_transaction", "gold.dim_date", "gold.dim_customer", "gold.dim_account",
                  "silver.transactions", "silver.stg_transactions", "bronze.transactions_raw"}
    lay = {r["layer"]: len(r["tables"]) for r in lineage.layers(e).collect()}
    assert lay == {"bronze": 1, "silver": 4, "gold": 6}
    assert [m.name for m in registry.topo_order()][0] == "stg_transactions"


def test_layout_zorder_prunes_and_rollups_agree(spark, tmp):
    src = fixture.volume_fact(spark, SF001)
    frag, zord, comp = (os.path.join(tmp, n) for n in ("frag", "zord", "comp"))
    layout.fragment(src, "transaction_id", 24, frag)
    held = spark.read.parquet(frag).select(layout.crc32_shard("transaction_id", 24).alias("s"),
                                           F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert len(held) == 24 == len({r["s"] for r in held}) == len({r["f"] for r in held})  # one shard per file
    # the worst layout: every file spans (almost) the whole date range
    span = layout.manifest(spark, frag, ["date_key"]).select(
        F.datediff("max_date_key", "min_date_key").alias("d")).agg(F.min("d")).first()[0]
    assert span > 2000
    layout.zorder(spark, frag, zord, ["date_key", "transaction_type"], n_files=6)
    n = layout.compact(spark, frag, comp, target_bytes=10 ** 9)
    assert n == 1 and layout.detail(spark, comp).first()["num_rows"] == src.count()
    lo, hi = "1998-06-08", "1998-06-21"
    pf = layout.profile(layout.manifest(spark, frag, ["date_key"]), "date_key", lo, hi).first()
    pz = layout.profile(layout.manifest(spark, zord, ["date_key"]), "date_key", lo, hi).first()
    assert pf["files_pruned"] == 0 and pz["files_pruned"] >= 4
    a = sorted(tuple(r) for r in rollup(spark.read.parquet(frag), lo, hi).collect())
    man = layout.write_manifest(spark, zord, ["date_key"])
    b = sorted(tuple(r) for r in rollup(layout.skipping_scan(spark, zord, man, "date_key", lo, hi),
                                        lo, hi).collect())
    assert a == b and len(a) > 0


def test_compared_measures(spark):
    before = spark.createDataFrame([(96, 0, 7)], "files long, pruned long, only_before long")
    after = spark.createDataFrame([(4, 3)], "files long, pruned long")
    got = {r["measure"]: (r["before"], r["after"], r["change"]) for r in layout.compared(before, after).collect()}
    assert got == {"files": (96, 4, -92 / 96), "pruned": (0, 3, None)}


def test_zorder_keys_spread_over_whole_values(spark):
    """Long common prefixes, fractions and outliers keep their order."""
    from ledgerline.functions.zorder import coordinate, cut_points, zorder_key
    df = spark.range(5000).select(F.format_string("ACCT-%012d", "id").alias("k"), (F.col("id") / 5000).alias("x"),
                                  F.when(F.col("id") == 9, 10 ** 15).otherwise(F.col("id")).alias("far"))
    for col in ("k", "x", "far"):
        cuts = cut_points(df, col)
        cells = df.select(col, coordinate(df, col, cuts).alias("c")).orderBy(col).collect()
        got = [r["c"] for r in cells]
        assert got == sorted(got) and len(set(got)) >= 900 and max(got) < 1024
    assert df.select(zorder_key(df, ["k", "x"]).alias("z")).distinct().count() >= 900
    few = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    assert [r[1] for r in few.select("k", zorder_key(few, ["k"])).orderBy(F.col("k").asc_nulls_first()).collect()] == [0, 0, 1, 2]


def test_deep_lineage_closes_and_cycles_are_errors(spark):
    import pytest
    chain_edges = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(70)], "upstream string, table_name string")
    assert lineage.upstream(chain_edges, "t70").count() == 70
    with pytest.raises(ValueError):
        lineage.upstream(spark.createDataFrame([("a", "b"), ("b", "a")], "upstream string, table_name string"), "a")


def test_no_view_of_the_session_shows_raw_ids(spark, tmp):
    from ledgerline.plans.governance import register_bronze
    from ledgerline.sources import bronze as bronze_table
    path = os.path.join(tmp, "bronze")
    bronze_table.ingest_batch(spark, path, "events/batch-0",
                              lambda: fixture.batch(spark, SF001, 0, stamped=False), "2024-02-01 00:00:00")
    for t in spark.catalog.listTables():
        spark.catalog.dropTempView(t.name)
    register_bronze(spark, path)
    for t in spark.catalog.listTables():
        df = spark.table(t.name)
        assert df.filter("nameOrig IS NOT NULL AND NOT startswith(nameOrig, '***')").isEmpty()


def test_registered_bronze_view_is_masked(spark, tmp):
    from ledgerline.plans.governance import register_bronze
    from ledgerline.sources import bronze as bronze_table
    path = os.path.join(tmp, "bronze")
    bronze_table.ingest_batch(spark, path, "events/batch-0",
                              lambda: fixture.batch(spark, SF001, 0, stamped=False), "2024-02-01 00:00:00")
    view = register_bronze(spark, path)
    ids = [r[0] for r in spark.sql(f"SELECT DISTINCT nameOrig FROM {view} WHERE nameOrig IS NOT NULL").collect()]
    assert ids and all(v.startswith("***") for v in ids)
    etl = register_bronze(spark, path, privileged=True, view="bronze_raw_etl")
    ids = [r[0] for r in spark.sql(f"SELECT DISTINCT nameOrig FROM {etl} WHERE nameOrig IS NOT NULL").collect()]
    assert ids and not any(v.startswith("***") for v in ids)
    # registering a privileged view (or a privileged SQL function) never
    # unmasks the consumer view: its mask is part of its definition
    from ledgerline.functions.masking import register_sql_mask
    register_sql_mask(spark, "mask_account", privileged=True)
    ids = [r[0] for r in spark.sql(f"SELECT DISTINCT nameOrig FROM {view} WHERE nameOrig IS NOT NULL").collect()]
    assert all(v.startswith("***") for v in ids)


def test_clustered_compaction_keeps_rows_and_clusters_files(spark, tmp):
    src = fixture.volume_fact(spark, SF001)
    frag, comp = os.path.join(tmp, "frag2"), os.path.join(tmp, "comp2")
    layout.fragment(src, "transaction_id", 24, frag)
    size = layout.detail(spark, frag).first()["size_bytes"]
    n = layout.compact(spark, frag, comp, target_bytes=size // 4 + 1, cluster_by=["date_key"])
    det = layout.detail(spark, comp).first()
    assert det["num_rows"] == src.count() and 1 <= det["num_files"] <= n
    spans = [r[0] for r in layout.manifest(spark, comp, ["date_key"]).select(
        F.datediff("max_date_key", "min_date_key")).collect()]
    total = src.agg(F.datediff(F.max("date_key"), F.min("date_key"))).first()[0]
    assert max(spans) < total  # every file covers a strict sub-range of the dates
    assert sorted(tuple(r) for r in spark.read.parquet(comp).collect()) == \
        sorted(tuple(r) for r in spark.read.parquet(frag).collect())
