"""Batch names are text, whatever they look like: bronze, its ledger, the
stream, incremental silver and the catalog keep them as they were given."""

import os

import pytest

from ledgerline.plans import incremental, registry
from ledgerline.session import read_partitioned
from ledgerline.sources import bronze as bronze_table
from ledgerline.sources import fixture
from ledgerline.sources.raw import RAW_COLUMNS, validate_source_name
from ledgerline.streaming.ingest import ingest_stream, landing_root
from tests.conftest import SF001

NAMES = ["007", "2024", "1e3", "2024-01-01", "1.50", "true", "0x1F", "12/07", "null"]


def land(spark, path, names, first_day=1):
    rows = fixture.batch(spark, SF001, 0, stamped=False)
    for i, name in enumerate(names):
        part = rows.filter(f"pmod(crc32(cast(concat_ws('|', *) as binary)), {len(names)}) = {i}")
        bronze_table.ingest_batch(spark, path, name, lambda p=part: p, f"2024-02-{first_day + i:02d} 00:00:00")


def names_of(df):
    assert dict(df.dtypes)["_source_file"] == "string"
    return sorted(r[0] for r in df.select("_source_file").distinct().collect())


def test_names_stay_as_given_and_land_once(spark, tmp):
    path = os.path.join(tmp, "bronze")
    land(spark, path, NAMES)
    before = bronze_table.row_count(spark, path)
    assert names_of(bronze_table.read_bronze(spark, path)) == sorted(NAMES)
    assert names_of(bronze_table.read_ledger(spark, path)) == sorted(NAMES)
    assert names_of(bronze_table.read_batches(spark, path, ["007", "1e3"])) == ["007", "1e3"]
    assert bronze_table.already_loaded(spark, path, "007") and not bronze_table.already_loaded(spark, path, "7")
    land(spark, path, NAMES)  # all loaded: the sources aren't read again
    assert bronze_table.row_count(spark, path) == before == bronze_table.read_bronze(spark, path).count()
    assert bronze_table.ingest_batch(spark, path, "7", fixture.batch(spark, SF001, 1, stamped=False), "2024-03-01 00:00:00") > before


def test_one_numeric_batch_alone(spark, tmp):
    path = os.path.join(tmp, "bronze")
    land(spark, path, ["007"])
    land(spark, path, ["2024"])
    assert names_of(bronze_table.read_bronze(spark, path)) == ["007", "2024"]


def test_a_table_without_ledger_falls_back_to_text_names(spark, tmp):
    path = os.path.join(tmp, "foreign")
    spark.createDataFrame([("a", "007"), ("b", "2024")], "v string, _source_file string") \
        .write.partitionBy("_source_file").parquet(path)
    assert bronze_table.already_loaded(spark, path, "007") and not bronze_table.already_loaded(spark, path, "7")
    assert names_of(bronze_table.read_bronze(spark, path)) == ["007", "2024"]
    assert names_of(read_partitioned(spark, path, ["_source_file"])) == ["007", "2024"]


def test_through_incremental_silver_and_the_catalog(spark, tmp):
    path, root = os.path.join(tmp, "bronze"), os.path.join(tmp, "lake")
    names = NAMES[:4]
    land(spark, path, names[:2])
    assert incremental.update_silver(spark, path, root) == 2
    land(spark, path, names)
    assert incremental.update_silver(spark, path, root) == 2
    assert incremental.update_silver(spark, path, root) == 0
    for table in (incremental.read_silver(spark, root), incremental.read_quarantine(spark, root)):
        assert names_of(table) == sorted(names)
    audit = incremental.audit(spark, root).first()
    assert audit["rows_tie"] and audit["amount_tie"] and audit["bronze_rows"] == bronze_table.row_count(spark, path)
    result = registry.run(spark, bronze_table.bronze_view(spark, path), root, incremental_silver=True, bronze_path=path)
    assert all(r["status"] == "pass" for r in result.checks) and len(result.checks) == 49
    registry.register_tables(spark, root)
    rows = spark.table("silver.transactions_quarantine")
    assert names_of(rows) == sorted(names) and rows.count() == incremental.read_quarantine(spark, root).count() > 0


def test_few_committed_names_prune_the_folders(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "bronze")
    land(spark, path, NAMES[:3])
    plan = bronze_table.read_bronze(spark, path)._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "PartitionFilters: [_source_file" in plan and "Join" not in plan
    want = sorted(tuple(r) for r in bronze_table.read_bronze(spark, path).collect())
    monkeypatch.setattr(bronze_table, "FILTERED_NAMES", 2)
    many = bronze_table.read_bronze(spark, path)
    assert "Join" in many._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert sorted(tuple(r) for r in many.collect()) == want


def test_the_name_of_a_missing_value_is_refused():
    with pytest.raises(ValueError):
        validate_source_name("__HIVE_DEFAULT_PARTITION__")


@pytest.mark.parametrize("form", ["{0}", "file:{0}", "file://{0}", "{0}/", "file://{0}/"])
def test_stream_names_are_relative_to_the_landing_folder(spark, tmp, form):
    landing = os.path.join(tmp, "a landing+zone")
    for w, folder in ((0, "007"), (1, "2024-01-01")):
        (fixture.batch(spark, SF001, w, stamped=False).coalesce(1).write.option("header", "true").option("escape", '"')
         .csv(os.path.join(landing, folder)))
    table = os.path.join(tmp, "bronze")
    where = form.format(landing)
    ingest_stream(spark, where, table, os.path.join(tmp, "ckpt"))
    names = names_of(bronze_table.read_bronze(spark, table))
    assert [n.split("/")[0] for n in names] == ["007", "2024-01-01"] and all(n.endswith(".csv") for n in names)
    assert bronze_table.read_bronze(spark, table).select(*RAW_COLUMNS).count() == 1048
    ingest_stream(spark, where, table, os.path.join(tmp, "another-ckpt"))  # the ledger knows them by the same names
    assert bronze_table.row_count(spark, table) == 1048


def test_landing_root_is_resolved_by_the_file_system(spark, tmp):
    assert {landing_root(spark, f) for f in (tmp, f"file:{tmp}", f"file://{tmp}", f"{tmp}/")} == {tmp + "/"}
    assert landing_root(spark, "landing") == os.path.join(os.getcwd(), "landing") + "/"
