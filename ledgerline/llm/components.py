"""Connected components of a large edge list by alternating star rewrites.

Each round connects the larger neighbours of every node to its smallest
neighbour ("large star"), then the smaller ones and the node itself ("small
star"); after about log(n) rounds every component is one star around its
smallest node.  Edges and minima stay in tables in the shared folder.  The
minima are stored before they are joined back, so that both join inputs are
plain shuffles and adaptive execution can split a node that a third of all
edges meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def _rewired(edges: DataFrame) -> DataFrame:
    """(a, b) rows -> a, b, m with m the smallest b of each a."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "minima")
    return edges.join(least, "a")


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(F.shiftright(mark, 16))).first())


def components(edges: DataFrame) -> DataFrame:
    """Undirected edges (a, b) -> node, root: root is the smallest node that
    can be reached.  Nodes without an edge to another node don't occur."""
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(_rewired(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
                       .filter("a <> b").distinct(), "edges")
        met = _rewired(large)
        edges = stored(met.select("a", F.col("m").alias("b")).unionByName(
            met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
