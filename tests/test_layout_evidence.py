"""The layout reports fail when the layout is not what it claims to be."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline import catalog
from ledgerline.operators import layout
from ledgerline.operators.footers import footers
from tests.conftest import SF001


@pytest.fixture(scope="module")
def layouts(spark):
    return catalog.build_layouts(spark, SF001)


@pytest.fixture()
def shuffled(spark, layouts, tmp):
    """The clustered table's rows in as many files, at random."""
    path = os.path.join(tmp, "shuffled")
    spark.read.parquet(layouts.zordered).repartition(catalog.LAYOUT_FILES, F.rand(7)).write.parquet(path)
    return path


def flags(df, *names):
    return {tuple(r[n] for n in names) for r in df.collect()}


def test_footers_say_what_the_files_hold(spark, layouts):
    for path in (layouts.fragmented, layouts.zordered):
        said = footers(spark, path, ["date_key", "transaction_type", "amount", "is_fraud"])
        rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(
            F.count("*"), F.min("date_key"), F.max("date_key"), F.min("transaction_type"), F.max("transaction_type"),
            F.min("amount"), F.max("amount"), F.min("is_fraud"), F.max("is_fraud"))
        want = sorted(tuple(r)[1:] for r in rows.collect())
        got = sorted((r["num_rows"], *r[4:]) for r in said.collect())
        assert got == want
        assert layout.boxes_hold(spark, path, ["date_key", "transaction_type"]).first()["holds"]


def test_footers_of_nulls_nested_folders_and_no_files(spark, tmp):
    path = os.path.join(tmp, "t")
    spark.createDataFrame([(1, None, "a"), (2, None, "b"), (None, None, "b")], "x int, y string, p string").coalesce(1) \
        .write.partitionBy("p").parquet(path)
    got = sorted((r["num_rows"], r["min_x"], r["max_x"], r["min_y"], r["max_y"]) for r in footers(spark, path, ["x", "y"]).collect())
    assert got == [(1, 1, 1, None, None), (2, 2, 2, None, None)]
    empty = os.path.join(tmp, "empty")
    os.makedirs(empty)
    assert layout.detail(spark, empty).first()[:] == (0, 0, 0)


def test_detail_reads_no_data(spark, layouts):
    det = layout.detail(spark, layouts.fragmented).first()
    assert (det["num_files"], det["num_rows"]) == (catalog.FRAGMENTS, spark.read.parquet(layouts.fragmented).count())
    folder = layouts.fragmented
    assert det["size_bytes"] == sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet"))


def test_a_table_that_was_not_compacted_fails(spark, layouts):
    assert flags(catalog.compact_report(spark, layouts.fragmented, layouts.compacted), "files_as_asked") == {(True,)}
    assert flags(catalog.compact_report(spark, layouts.fragmented, layouts.fragmented), "files_as_asked") == {(False,)}


def test_uneven_files_fail(spark, layouts, tmp):
    path = os.path.join(tmp, "uneven")
    rows = spark.read.parquet(layouts.compacted)
    rows.withColumn("k", F.least(F.floor(F.rand(3) * 40), F.lit(7)).cast("int")).repartitionById(8, "k").drop("k").write.parquet(path)
    assert footers(spark, path).count() == 8
    assert flags(catalog.compact_report(spark, layouts.fragmented, path), "files_as_asked") == {(False,)}


def test_a_table_that_was_not_clustered_fails(spark, layouts, shuffled):
    assert flags(catalog.zorder_report(spark, layouts.zordered), "files_in_order", "boxes_hold") == {(True, True)}
    assert flags(catalog.zorder_report(spark, shuffled), "files_in_order", "boxes_hold") == {(False, True)}


def test_a_table_that_prunes_nothing_shows(spark, layouts, shuffled):
    names = ("reads_its_boxes", "all_files_counted", "prunes")
    assert flags(catalog.profile_report(spark, "z", layouts.zordered), *names) == {(True, True, True)}
    assert flags(catalog.profile_report(spark, "s", shuffled), *names) == {(True, True, False)}


def test_a_wrong_manifest_shows(spark, layouts, monkeypatch):
    true = layout.manifest

    def narrowed(spark, path, cols):  # one file's box misses the window
        files = true(spark, path, cols)
        one = files.agg(F.min("file_path")).first()[0]
        return files.withColumn("min_date_key", F.when(F.col("file_path") == one, F.lit("2999-01-01").cast("date")).otherwise(F.col("min_date_key")))

    monkeypatch.setattr(layout, "manifest", narrowed)
    assert flags(catalog.profile_report(spark, "f", layouts.fragmented), "reads_its_boxes") == {(False,)}
    assert flags(catalog.zorder_report(spark, layouts.zordered), "boxes_hold") == {(False,)}


def test_many_kept_files_are_joined_not_listed(spark, layouts, monkeypatch):
    man = layout.write_manifest(spark, layouts.zordered, ["date_key"])
    lo, hi = "1994-01-01", "1996-12-31"
    want = sorted(map(str, layout.opened(spark, layouts.zordered, man, "date_key", lo, hi).collect()))
    monkeypatch.setattr(layout, "LISTED_FILES", 1)
    assert sorted(map(str, layout.opened(spark, layouts.zordered, man, "date_key", lo, hi).collect())) == want
    assert 0 < len(want) < spark.read.parquet(layouts.zordered).count()


def test_cells_go_to_equal_shares(spark):
    import random
    rng = random.Random(4)
    for n_files in (1, 3, 8):
        counts = [rng.choice([1, 2, 5, 40]) for _ in range(30)] + [900]  # the last is larger than a share
        rng.shuffle(counts)
        cells = spark.createDataFrame(list(enumerate(counts)), "_z long, _n long")
        got = {r["_z"]: (r["_first"], r["_files"]) for r in layout.cell_files(cells, n_files).collect()}
        total, before = sum(counts), 0
        for z, n in enumerate(counts):
            if n * n_files > total:
                want = (before * n_files // total, (before + n - 1) * n_files // total - before * n_files // total + 1)
            else:
                want = ((2 * before + n - 1) * n_files // (2 * total), 1)
            assert got[z] == want
            before += n


def test_whole_cells_keep_rows_order_and_hot_cells_apart(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50)  # a third of the rows in one cell
    rows = spark.range(3000).select(hot.alias("a"), (F.col("id") % 2).alias("b"), "id").filter("a <> 7 OR b = 1 OR id % 3 > 0")
    rows.repartition(5).write.parquet(src)
    n = layout.zorder_cells(spark, src, out, ["a", "b"], n_files=6)
    files = footers(spark, out, ["a"])
    assert n == 6 and files.count() == 6
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, spark.read.parquet(src).collect()))
    mean = spark.read.parquet(src).count() / 6
    assert files.agg(F.max("num_rows")).first()[0] < 2 * mean
    again = os.path.join(tmp, "again")
    layout.zorder_cells(spark, src, again, ["a", "b"], n_files=6)
    boxes = [sorted((r["num_rows"], r["min_a"], r["max_a"]) for r in footers(spark, p, ["a"]).collect()) for p in (out, again)]
    assert boxes[0] == boxes[1]


def test_whole_cells_are_in_key_order_when_no_cell_is_split(spark, layouts, tmp):
    out = os.path.join(tmp, "cells")
    layout.zorder_cells(spark, layouts.fragmented, out, catalog.CLUSTER_BY, n_files=8)
    assert flags(catalog.zorder_report(spark, out), "files_in_order", "boxes_hold") == {(True, True)}
    cost = layout.benchmark(spark, out, "date_key", *catalog.VOLUME_WINDOW).first()
    assert cost["files_read"] + cost["files_pruned"] == cost["files_total"] == 8 and cost["files_pruned"] > 0
    assert cost["window_rows"] <= cost["rows_read"] < cost["rows_total"]


def test_rewrites_shuffle_rows_of_arrays(spark, tmp):
    """A task that writes a file reads all of it: hashes go as bytes, and the
    rows of a cell together."""
    ids = F.when(F.col("id") % 50 == 0, F.element_at(F.array(*[F.lit(x) for x in ("", "AB", "abc", "zz", "00")], F.lit(None)),
                                                     (F.col("id") / 50 % 6 + 1).cast("int"))).otherwise(F.sha2(F.col("id").cast("string"), 256))
    rows = spark.range(6000, numPartitions=2).select(
        ids.alias("a.id"), (F.col("id") % 20).alias("k"), F.expr("CASE WHEN id % 7 > 0 THEN CAST(id % 7 AS DECIMAL(18,2)) END AS m"))
    chunks, back = layout._chunked(rows.withColumn("_file", (F.col("k") % 3).cast("int")).withColumn("_z", F.col("k")), ["_file", "_z"])
    assert chunks.count() == 2 * 20
    bytes_of = F.aggregate("c0", F.lit(0), lambda n, x: n + F.coalesce(F.length(x), F.lit(0)))
    assert chunks.agg(F.sum(bytes_of)).first()[0] == 32 * 5880 + 20  # and "00" of 20 rows
    src, out = f"{tmp}/src", f"{tmp}/out"
    rows.write.parquet(src)
    want = sorted(map(str, rows.collect()))
    layout.compact(spark, src, out, target_bytes=layout.detail(spark, src).first()["size_bytes"] // 4 + 1)
    assert sorted(map(str, spark.read.parquet(out).collect())) == want
    layout.zorder(spark, src, out, ["k", "m"], n_files=5)
    assert sorted(map(str, spark.read.parquet(out).collect())) == want
    sizes = [r[0] for r in footers(spark, out).select("num_rows").collect()]
    assert len(sizes) == 5 and max(sizes) < 1.2 * min(sizes)


def test_rewrites_shuffle_little_more_than_the_hashes(spark, tmp):
    """What a file's task reads is near what can't be compressed, with many
    cells too, and it opens a stretch of the sorted file at a time."""
    rows = spark.range(40_000, numPartitions=1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"), F.expr("date_add(DATE '1992-01-01', CAST(id * 7919 % 1000 AS INT))").alias("day"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("kind"),
        F.expr("CAST(id * 104729 % 9000000 / 100 AS DECIMAL(18,2))").alias("amount"), (F.col("id") % 11 == 0).alias("flag"))
    chunks, back = layout._chunked(rows.select("*", F.lit(0).alias("_file")), ["_file"], packed=True)
    assert chunks.agg(F.sum(F.length("chunk"))).first()[0] < 40 * 40_000
    fields = layout._slim(rows, [])[0].schema
    assert sorted(map(str, layout._unpacked(chunks, fields).select(*back).collect())) == sorted(map(str, rows.collect()))


def test_files_are_sorted_over_stretches_and_hot_cells(spark, tmp, monkeypatch):
    monkeypatch.setattr(layout, "STRETCH_BITS", 6)
    monkeypatch.setattr(layout, "CHUNK_ROWS", 16)
    monkeypatch.setattr(layout, "HELD_ROWS", 300)
    spread = F.pmod(F.hash("id"), F.lit(400))
    rows = spark.range(6000, numPartitions=3).select(  # a third of the rows in one cell, the others in many
        "id", F.when(F.col("id") % 3 == 0, F.lit(200)).otherwise(spread).alias("a"), F.expr("IF(id % 3 = 0, 'x', CAST(id % 5 AS STRING))").alias("b"))
    src = f"{tmp}/src"
    rows.write.parquet(src)
    want = sorted(map(tuple, rows.collect()))
    for write in (layout.zorder, layout.zorder_cells):
        out = f"{tmp}/{write.__name__}"
        assert write(spark, src, out, ["a", "b"], n_files=3) == 3
        back = spark.read.parquet(out)
        assert sorted(map(tuple, back.collect())) == want and footers(spark, out).count() == 3
        keyed = back.select("_metadata.file_path", "_metadata.row_index", layout.zorder_key(back, ["a", "b"]).alias("z"))
        for f, in back.select("_metadata.file_path").distinct().collect():
            zs = [r["z"] for r in keyed.filter(F.col("file_path") == f).orderBy("row_index").collect()]
            assert zs == sorted(zs) and len(zs) > 1000


def test_keys_are_worked_out_for_values_not_for_rows(spark, tmp, monkeypatch):
    path = os.path.join(tmp, "t")
    rows = [(i, None if i % 7 == 0 else i % 5, (None, "A", "", "A ", "b")[i % 5] if i % 3 else "z", float("nan") if i % 11 == 0 else -0.0 if i % 2 else 0.0)
            for i in range(400)]
    spark.createDataFrame(rows + rows[:50], "i int, a int, b string, c double").repartition(3).write.parquet(path)
    df, cols = spark.read.parquet(path), ["a", "b", "c"]
    want = sorted(map(tuple, df.select("i", layout.zorder_key(df, cols)).collect()))
    sizes = {}
    for _, z in want:
        sizes[z] = sizes.get(z, 0) + 1
    for most in (layout.LISTED_VALUES, 1):
        monkeypatch.setattr(layout, "LISTED_VALUES", most)
        keyed = layout._beside_cells(df, cols, layout._placed)
        got = keyed.select("i", "_z", "_n").collect()
        assert sorted((r["i"], r["_z"]) for r in got) == want
        assert all(r["_n"] == sizes[r["_z"]] for r in got)
        plan = keyed._jdf.queryExecution().optimizedPlan().toString().splitlines()
        left = min(x.index(":") for x in plan if x.lstrip().startswith(":"))
        of_rows = [x for x in plan if x[left:left + 1] == ":"]  # the join's left side
        assert of_rows and any("aggregate(" in x for x in of_rows) == (most == 1)


def test_hexadecimal_texts_go_as_bytes_and_come_back():
    import random

    import pyarrow as pa
    rng = random.Random(6)
    for k in range(150):
        pool = ["ab" * rng.randrange(5), "f0" * 32, "09"] + ([] if k % 3 == 0 else [None, "", "AB", "abc", "zz", "00", "é", "0é"])
        texts = pa.array([rng.choice(pool) for _ in range(rng.randrange(40))], pa.string())
        texts = texts.slice(rng.randrange(len(texts) + 1), rng.randrange(len(texts) + 1))
        known, others = layout._hex_bytes(texts)
        known.validate(full=True), others.validate(full=True)
        plain = texts.to_pylist()
        same = [t is not None and len(t) % 2 == 0 and set(t) <= set("0123456789abcdef") for t in plain]
        assert known.to_pylist() == [bytes.fromhex(t) if s else None for t, s in zip(plain, same)]
        assert others.to_pylist() == [None if s else t for t, s in zip(plain, same)]
        for a in (0, 1):
            assert layout._texts(known.slice(a), others.slice(a)).to_pylist() == plain[a:]


def test_numbers_sort_as_one_where_they_fit():
    import numpy as np
    rng = np.random.default_rng(8)
    for low, high in ((0, 5), (-3, 4), (-2 ** 62, 2 ** 62)):
        keys = [rng.integers(low, high, 500), rng.integers(0, 8, 500).astype(np.int32), rng.integers(low, high, 500)]
        assert layout._sorted_places(keys).tolist() == np.lexsort(keys[::-1]).tolist()
