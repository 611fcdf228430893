from pyspark.sql import functions as F

from ledgerline.llm.common import maybe_among


def test_filter_of_fixed_size_loses_nothing(spark):
    for n, most in ((0, 24), (1, 24), (500, 24), (5000, 24), (5000, 10)):
        values = spark.range(n).select((F.col("id") * 7919).alias("v"))
        test = maybe_among(values, "v", most)
        assert values.filter(test(F.col("v"))).count() == n
        others = spark.range(10_000).select((F.col("id") * 7919 + 1).alias("v")).filter(test(F.col("v"))).count()
        assert others < 500 or most == 10
    words = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    test = maybe_among(words, "v")
    assert spark.createDataFrame([("a",), ("b",)], "x string").filter(test(F.col("x"))).count() == 2
