"""The distributed global index / ntile against Spark's single-partition window."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.rank import ntile_global, tile_of, with_global_index


def _compare(spark, values, n, parts):
    df = spark.createDataFrame([(v, f"k{i:05d}") for i, v in enumerate(values)], "v long, k string")
    df = df.repartition(parts)
    ours = {r["k"]: r["t"] for r in ntile_global(df, n, ["v", "k"], "t").collect()}
    ref = {r["k"]: r["t"] for r in df.withColumn("t", F.ntile(n).over(Window.orderBy("v", "k"))).collect()}
    assert ours == ref


@pytest.mark.parametrize("n,parts", [(3, 1), (3, 5), (4, 7), (10, 3)])
def test_ntile_matches_window_with_heavy_ties(spark, n, parts):
    rnd = random.Random(n * 31 + parts)
    # one value holds about a third of the rows (the hot tie block)
    values = [0 if rnd.random() < 0.35 else rnd.randint(-50, 50) for _ in range(997)]
    _compare(spark, values, n, parts)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=0, max_size=40), st.integers(1, 6))
def test_ntile_property(spark, values, n):
    if not values:
        return
    _compare(spark, values, n, 3)


def test_global_index_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(9)
    out, total = with_global_index(df, ["x"], "i")
    rows = out.select("x", "i").collect()
    assert total == 5000
    assert sorted(r["i"] for r in rows) == list(range(5000))
    assert all(r["x"] == r["i"] for r in rows)


def test_tile_arithmetic_small(spark):
    df = spark.range(0, 2)
    got = [r[0] for r in df.select(tile_of(F.col("id"), 2, 3)).collect()]
    assert got == [1, 2]


def test_empty_input(spark):
    df = spark.createDataFrame([], "v long, k string")
    assert ntile_global(df, 3, ["v", "k"]).count() == 0


def test_hot_identical_group_is_spread_over_partitions(spark):
    """A third of the rows identical: the sorted, checkpointed frame must not
    put them all into one range partition."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # tiny data would be merged back
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        hot = spark.range(0, 3000).select(F.lit(7).alias("v"))
        rest = spark.range(0, 6000).select((F.col("id") % 977).alias("v"))
        df = hot.unionByName(rest).repartition(8)
        out, total = with_global_index(df, ["v"], "i", spread_ties=True)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set(key, old)
    assert total == 9000 and max(sizes) < 3000
    assert sorted(r["i"] for r in out.select("i").collect()) == list(range(9000))


def test_offsets_of_many_partitions_are_a_relation(spark):
    """20,000 partitions, some empty: dense positions, and a plan that is as
    long as that of eight (no literal for each partition)."""
    from ledgerline.operators.rank import partition_offsets, place

    def placed(parts):
        rows = spark.range(parts).filter("id % 4 > 0").select(F.col("id").cast("int").alias("_pid"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("id") % 4 - 1)).alias("at"))
        tagged = rows.select("_pid", (F.shiftleft(F.col("_pid").cast("bigint"), 33) + F.col("at")).alias("_mid"), "at", F.col("_pid").alias("p"))
        offsets, n, total = partition_offsets(tagged)
        return place(tagged, offsets, n, "i"), total

    few, many = placed(8), placed(20_000)
    got = [r["i"] for r in many[0].orderBy("p", "at").collect()]
    assert got == list(range(many[1])) and many[1] == 30_000
    sizes = [len(df._jdf.queryExecution().analyzed().toString()) for df, _ in (few, many)]  # noqa: SLF001
    assert abs(sizes[0] - sizes[1]) < 400
