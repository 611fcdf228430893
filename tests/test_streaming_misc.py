"""Micro-batch upsert stream, parameterised ledger lookup, sample edge cases."""

import os

from pyspark.sql import functions as F

from ledgerline.catalog import chain
from ledgerline.plans import gold
from ledgerline.sources import bronze as bronze_table
from ledgerline.sources import fixture
from ledgerline.sources.sample import systematic_sample
from ledgerline.streaming.ingest import upsert_stream
from tests.conftest import SF001


def test_upsert_stream_latest_wins_out_of_order(spark, tmp):
    """Silver rows arrive as files (newest batch first); the fact ends equal
    to the full rebuild because the older correction never overwrites."""
    c = chain(spark, SF001)
    eligible = c.eligible
    src, fact_path, ckpt = (os.path.join(tmp, n) for n in ("silver_in", "fact", "ckpt"))
    later = eligible.filter(F.col("_source_file") == fixture.BATCH_1[0])
    earlier = eligible.filter(F.col("_source_file") == fixture.BATCH_0[0])
    later.write.parquet(os.path.join(src, "f1"))
    stream = spark.readStream.schema(eligible.schema).option("recursiveFileLookup", "true").parquet(src)
    upsert_stream(spark, stream, fact_path, os.path.join(ckpt, "a"), gold.fact)
    earlier.write.parquet(os.path.join(src, "f0"))
    upsert_stream(spark, stream, fact_path, os.path.join(ckpt, "a"), gold.fact)
    got = sorted(tuple(r) for r in spark.read.parquet(fact_path).select(*gold.FACT_COLUMNS).collect())
    want = sorted(tuple(r) for r in c.fact.select(*gold.FACT_COLUMNS).collect())
    assert got == want


def test_parameterised_ledger_lookup(spark, tmp):
    path = os.path.join(tmp, "bronze")
    bronze_table.ingest_batch(spark, path, "events/batch-0",
                              lambda: fixture.batch(spark, SF001, 0, stamped=False), "2024-02-01 00:00:00")
    spark.read.parquet(path).createOrReplaceTempView("bronze_raw_t")
    assert bronze_table.loaded_rows_sql(spark, "bronze_raw_t", "events/batch-0") > 0
    assert bronze_table.loaded_rows_sql(spark, "bronze_raw_t", "events/batch-1") == 0


def test_sample_stride_one_takes_first_rows(spark):
    df = spark.range(0, 15).withColumn("g", F.col("id") % 4)
    out = sorted(r["id"] for r in systematic_sample(df, 10, ["id"]).collect())
    assert out == list(range(10))  # total < 2n -> stride 1 -> the first n rows
    out = sorted(r["id"] for r in systematic_sample(spark.range(0, 100), 10, ["id"]).collect())
    assert out == list(range(0, 100, 10))


def test_sample_is_partition_independent(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("v"))
    a = sorted(r["v"] for r in systematic_sample(df.repartition(1), 33, ["v"]).collect())
    b = sorted(r["v"] for r in systematic_sample(df.repartition(13), 33, ["v"]).collect())
    assert a == b and len(a) == 33


def test_unsafe_name_never_reaches_sql(spark):
    import pytest
    with pytest.raises(ValueError):
        bronze_table.loaded_rows_sql(spark, "bronze_raw_t", "x' OR '1'='1")
    with pytest.raises(ValueError):
        bronze_table.loaded_rows_sql(spark, "t; DROP TABLE x", "events/batch-0")


def test_file_order_sample_matches_brute_force(spark, tmp):
    from ledgerline.sources.sample import systematic_sample_files
    path = os.path.join(tmp, "t")
    spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(5).write.parquet(path)
    df = spark.read.parquet(path).select("v", F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.row_index").alias("r"))
    ordered = [row["v"] for row in sorted(df.collect(), key=lambda x: (x["f"], x["r"]))]
    stride = len(ordered) // 30
    want = [v for i, v in enumerate(ordered) if i % stride == 0 and i < 30 * stride]
    got = [r["v"] for r in systematic_sample_files(spark, path, 30).orderBy("_index").collect()]
    assert got == want and len(got) == 30


def test_scale_profile_sizes_partitions(spark):
    from ledgerline.session import scale_profile
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.files.maxPartitionBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    try:
        big = scale_profile(spark, 100 * (1 << 40))  # 100 TiB at 256 MiB per partition, no cap
        assert big["spark.sql.shuffle.partitions"] == "409600"
        mid = scale_profile(spark, 1 << 40)  # 1 TiB at 256 MiB per partition
        assert mid["spark.sql.shuffle.partitions"] == "4096"
        small = scale_profile(spark, 10 << 20)
        assert small["spark.sql.shuffle.partitions"] == "200"
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_cli_ingest_run_register(spark, tmp):
    """End to end through the command line entry points, in-process."""
    import json as _json
    from contextlib import redirect_stdout
    from io import StringIO

    from ledgerline.__main__ import main
    csv_dir, bronze_path, root = (os.path.join(tmp, n) for n in ("csv", "bronze", "lake"))
    for w in (0, 1):
        fixture.batch(spark, SF001, w, stamped=False).write.option("header", "true") \
            .csv(os.path.join(csv_dir, f"b{w}"))

    def call(*argv):
        buf = StringIO()
        with redirect_stdout(buf):
            main(list(argv))
        return _json.loads(buf.getvalue().strip().splitlines()[-1])

    assert call("ingest", "--bronze", bronze_path, "--source", os.path.join(csv_dir, "b0"),
                "--name", "events/batch-0")["rows"] > 0
    assert call("ingest", "--bronze", bronze_path, "--source", os.path.join(csv_dir, "b1"),
                "--name", "events/batch-1")["rows"] == 1048
    out = call("run", "--bronze", bronze_path, "--root", root, "--register")
    assert out["passed"] == out["checks"] == 49
    assert "gold.mart_daily_settled_volume" in out["tables"]
    n = spark.sql("SELECT count(*) FROM gold.fact_transaction WHERE date_key >= DATE'2023-01-15'").first()[0]
    assert n > 0


def test_results_do_not_depend_on_session_time_zone(spark):
    """Event clock, calendar and mart computed under a non-UTC session zone
    equal the UTC results (every clock is TIMESTAMP_NTZ)."""
    from ledgerline import catalog
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    out = {}
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set(key, tz)
            out[tz] = [sorted(tuple(r) for r in q(spark, SF001).collect())
                       for q in (catalog.q_stg_event_clock, catalog.q_dim_date, catalog.q_mart,
                                 catalog.q_bronze_stamp)]
    finally:
        spark.conf.set(key, old)
    assert out["UTC"] == out["America/New_York"] == out["Asia/Kolkata"]
