"""Landing, the bronze ledger and the stream: idempotency and negative cases."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import bronze as bronze_table
from ledgerline.sources import fixture
from ledgerline.sources.raw import RAW_COLUMNS, bronze_schema, read_raw, stamp, validate_source_name
from ledgerline.streaming.ingest import ingest_stream
from tests.conftest import SF001


@pytest.mark.parametrize("bad", ["", "/abs/path.csv", "../up.csv", "a/../b", "x;drop", "a b", "x\n"])
def test_unsafe_source_names(bad):
    with pytest.raises(ValueError):
        validate_source_name(bad)


def test_safe_source_names():
    for ok in ("raw/source.csv", "events/batch-0", "a__b", "v1.2_x-y"):
        assert validate_source_name(ok) == ok


def test_missing_pii_column_refuses():
    with pytest.raises(ValueError, match="mask"):
        bronze_schema(["step", "type", "nameOrig"])
    assert bronze_schema(list(RAW_COLUMNS))["_load_ts"].dataType.simpleString() == "timestamp_ntz"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_raw_strings_nulls_and_short_rows(spark, tmp):
    p = os.path.join(tmp, "in", "a.csv")
    _write(p, 'step,type,nameOrig,nameDest\n1,PAYMENT,C1,M1\n2,"TRANS,FER",NA,\n3,DEBIT\n')
    df = read_raw(spark, p)
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)
    rows = df.collect()
    assert rows[1]["type"] == "TRANS,FER" and rows[1]["nameOrig"] is None and rows[1]["nameDest"] is None
    assert rows[2]["nameOrig"] is None  # short row padded


def test_read_raw_long_row_fails(spark, tmp):
    p = os.path.join(tmp, "in2", "a.csv")
    _write(p, "step,type\n1,PAYMENT\n2,DEBIT,EXTRA\n")
    with pytest.raises(Exception, match="longer than the header"):
        read_raw(spark, p).collect()


def test_read_raw_empty_source_fails(spark, tmp):
    p = os.path.join(tmp, "in3", "a.csv")
    _write(p, "step,type\n")
    with pytest.raises(ValueError, match="0 rows"):
        read_raw(spark, p, ["step", "type"])


def test_stamp_is_one_value_per_batch(spark):
    df = stamp(fixture.batch(spark, SF001, 0, stamped=False), "events/batch-0")
    assert df.select("_load_ts").distinct().count() == 1
    assert df.select("_source_file").distinct().first()[0] == "events/batch-0"


def test_ingest_twice_equals_once_and_names_stay_apart(spark, tmp):
    path = os.path.join(tmp, "bronze")
    calls = []

    def src(w):
        def read():
            calls.append(w)
            return fixture.batch(spark, SF001, w, stamped=False)
        return read

    n1 = bronze_table.ingest_batch(spark, path, "a/b", src(0), "2024-02-01 00:00:00")
    n2 = bronze_table.ingest_batch(spark, path, "a/b", src(0), "2024-02-03 00:00:00")
    assert n1 == n2 and calls == [0]  # second call never read the source
    n3 = bronze_table.ingest_batch(spark, path, "a__b", src(1), "2024-02-02 00:00:00")
    b = bronze_table.read_bronze(spark, path)
    names = {r[0]: r[1] for r in b.groupBy("_source_file").count().collect()}
    assert set(names) == {"a/b", "a__b"} and n3 == n1 + names["a__b"]
    assert bronze_table.already_loaded(spark, path, "a/b")
    assert not bronze_table.already_loaded(spark, path, "a/c")


def test_stream_lands_each_file_once(spark, tmp):
    landing, table, ckpt = (os.path.join(tmp, n) for n in ("landing", "bronze", "ckpt"))
    fixture.batch(spark, SF001, 0, stamped=False).coalesce(1).write.option("header", "true") \
        .csv(os.path.join(landing, "b0"))
    ingest_stream(spark, landing, table, ckpt)
    first = spark.read.parquet(table).count()
    ingest_stream(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == first
    fixture.batch(spark, SF001, 1, stamped=False).coalesce(1).write.option("header", "true") \
        .csv(os.path.join(landing, "b1"))
    ingest_stream(spark, landing, table, ckpt)
    t = spark.read.parquet(table)
    assert t.count() == 1048
    assert t.filter(F.col("_source_file").startswith("/")).count() == 0


def test_partition_path_matches_spark_escaping(spark, tmp):
    path = os.path.join(tmp, "bronze")
    for name in ("events/batch-0", "a.b_c-d"):
        bronze_table.ingest_batch(spark, path, name, lambda: fixture.batch(spark, SF001, 1, stamped=False),
                                  "2024-02-02 00:00:00")
        assert os.path.isdir(bronze_table.partition_path(path, name))
    got = bronze_table.read_batches(spark, path, ["events/batch-0"])
    assert got.select("_source_file").distinct().collect()[0][0] == "events/batch-0"


def test_columns_go_by_header_name(spark, tmp):
    p = os.path.join(tmp, "swap")
    _write(p + "/a.csv", "step,nameDest,type,nameOrig\n1,M1,PAYMENT,C1\n")
    row = read_raw(spark, p, ["step", "type", "nameOrig", "nameDest"]).first()
    assert row.asDict() == {"step": "1", "type": "PAYMENT", "nameOrig": "C1", "nameDest": "M1"}
    with pytest.raises(ValueError, match="header"):
        read_raw(spark, p, ["step", "type"])
    _write(p + "/b.csv", "step,type,nameOrig,nameDest\n2,PAYMENT,C2,M2\n")
    with pytest.raises(Exception):  # two orders in one folder never land swapped
        read_raw(spark, p, ["step", "type", "nameOrig", "nameDest"]).collect()


def test_long_row_fails_whatever_is_selected(spark, tmp):
    p = os.path.join(tmp, "long", "a.csv")
    _write(p, "step,type\n1,PAYMENT\n2,DEBIT,EXTRA\n")
    with pytest.raises(Exception, match="longer than the header"):
        read_raw(spark, p, allow_empty=True).select("type").collect()


HEADER = ",".join(RAW_COLUMNS)


def test_stream_has_the_batch_contract(spark, tmp):
    good = "1,PAYMENT,5.00,C1,9,4,M1,0,0,0,0"
    swapped = ",".join(reversed(RAW_COLUMNS)) + "\n" + ",".join(reversed(good.split(","))) + "\n"
    landing, table, ckpt = (os.path.join(tmp, n) for n in ("land", "table", "ckpt"))
    _write(landing + "/b/one.csv", swapped)
    ingest_stream(spark, landing, table, ckpt)
    row = bronze_table.read_bronze(spark, table).first()
    assert (row["nameOrig"], row["nameDest"], row["_source_file"]) == ("C1", "M1", "b/one.csv")
    _write(landing + "/b/two.csv", f"{HEADER}\n{good}\n{good},EXTRA,MORE\n")
    with pytest.raises(Exception, match="longer than the header"):
        ingest_stream(spark, landing, table, ckpt)
    assert bronze_table.read_bronze(spark, table).count() == 1
    with pytest.raises(ValueError, match="mask columns"):
        ingest_stream(spark, landing, table, ckpt, columns=["step", "type"])


def test_unsafe_names_are_refused_before_anything_is_written(spark, tmp):
    landing, table, ckpt = (os.path.join(tmp, n) for n in ("land", "table", "ckpt"))
    _write(landing + "/a b.csv", f"{HEADER}\n1,PAYMENT,5.00,C1,9,4,M1,0,0,0,0\n")
    with pytest.raises(Exception, match="source name"):
        ingest_stream(spark, landing, table, ckpt)
    assert not bronze_table.table_exists(spark, table)


def test_readers_see_committed_batches_only(spark, tmp):
    path = os.path.join(tmp, "bronze")
    bronze_table.ingest_batch(spark, path, "one", lambda: fixture.batch(spark, SF001, 1, stamped=False), "2024-02-02 00:00:00")
    n = bronze_table.read_bronze(spark, path).count()
    stray = stamp(fixture.batch(spark, SF001, 1, stamped=False), "two", "2024-02-03 00:00:00")
    stray.write.mode("append").partitionBy("_source_file").parquet(path)  # died before its ledger row
    assert bronze_table.read_bronze(spark, path).count() == n == bronze_table.bronze_view(spark, path).count()
