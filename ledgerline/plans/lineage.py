"""Table lineage recorded by the model registry (no catalog API needed).

Edges come from each model's declared inputs, so the graph is exactly what
the runner executes -- including the reconciliation view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_root


def edges(spark: SparkSession, models=None) -> DataFrame:
    """``upstream, table_name`` pairs (sources have a NULL upstream)."""
    from ledgerline.plans.registry import MODELS, SOURCES
    models = models if models is not None else MODELS
    rows = [(None, s) for s in SOURCES]
    for m in models:
        rows += [(dep, m.qualified) for dep in m.depends_on] or [(None, m.qualified)]
    return spark.createDataFrame(rows, "upstream string, table_name string").distinct()


def upstream(edge_df: DataFrame, table: str) -> DataFrame:
    """Transitive upstream closure of ``table`` by iterative semi-join, until a
    round adds nothing; a table that is upstream of itself is an error."""
    e = edge_df.filter(F.col("upstream").isNotNull())
    frontier = e.filter(F.col("table_name") == table).select("upstream").distinct()
    checkpoint_root(edge_df.sparkSession)
    seen = frontier = frontier.checkpoint()  # each round is stored, so a deep graph doesn't grow the plan
    while True:
        nxt = (e.join(frontier.withColumnRenamed("upstream", "table_name"), "table_name", "left_semi")
               .select("upstream").distinct().join(seen, "upstream", "left_anti")).checkpoint()
        if nxt.isEmpty():
            break
        seen = seen.unionByName(nxt).checkpoint()
        frontier = nxt
    if not seen.filter(F.col("upstream") == table).isEmpty():
        raise ValueError(f"lineage of {table} has a cycle")
    return seen.withColumnRenamed("upstream", "table_name").orderBy("table_name")


def layers(edge_df: DataFrame) -> DataFrame:
    """Tables grouped by medallion layer (the schema part of the name)."""
    tables = (edge_df.select("table_name").unionByName(
        edge_df.select(F.col("upstream").alias("table_name"))).filter(F.col("table_name").isNotNull())
        .distinct())
    return (tables.withColumn("layer", F.split("table_name", r"\.").getItem(0))
            .groupBy("layer").agg(F.sort_array(F.collect_list("table_name")).alias("tables")))
