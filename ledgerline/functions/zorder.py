"""Z-order (Morton) keys from built-in functions.

Each clustering column is cut at quantiles of its distinct values into at most
``2^bits`` cells; a row's coordinate is the number of cut points at or below
its value, found by binary search.  The cut points are whole values of the
column itself, so any ordered type works the same way at any size: long common
prefixes, fractions and outliers don't collapse into one cell.  Columns with
few values get one cell per value.

The coordinates' bits are interleaved, aligned at the least significant one --
the canonical Morton order on an integer grid -- so rows close in every
clustering column get close keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.rank import with_global_index

CELL_BITS = 10
KEY_BITS = 62


def cut_points(df: DataFrame, col: str, bits: int = CELL_BITS) -> list:
    """At most ``2^bits - 1`` values that cut the sorted distinct values of
    ``col`` into cells of equal size (the first cell begins below them all)."""
    values, n = with_global_index(df.select(col).filter(F.col(col).isNotNull()).distinct(), [col], "_at")
    size = -(-n // (1 << bits)) if n else 1
    cuts = values.filter((F.col("_at") > 0) & (F.pmod("_at", F.lit(size)) == 0)).select(col)
    return sorted(r[0] for r in cuts.collect())


def coordinate(df: DataFrame, col: str, cuts: list) -> Column:
    """How many of the cut points are at or below the value (NULL: none)."""
    if not cuts:
        return F.lit(0).cast("bigint")
    points = F.array(*[F.lit(c) for c in cuts]).cast(f"array<{df.schema[col].dataType.simpleString()}>")
    steps = F.array(*[F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.get(points, at + step - 1) <= F.col(col), step).otherwise(0))
    return found.cast("bigint")


def zorder_key(df: DataFrame, cols: list[str], bits: int = CELL_BITS) -> Column:
    """Interleaved key over ``cols`` (first column wins ties at each level)."""
    if not cols:
        raise ValueError("zorder_key needs at least one column")
    if len(cols) * bits > KEY_BITS:
        raise ValueError(f"{len(cols)} columns of {bits} bits don't fit a key of {KEY_BITS}")
    cuts = [cut_points(df, c, bits) for c in cols]
    cells = [coordinate(df, c, x) for c, x in zip(cols, cuts)]
    depth = [len(x).bit_length() for x in cuts]
    # from the least significant level up; within a level the last column first
    places = [(level, j) for level in range(max(depth)) for j in reversed(range(len(cols))) if depth[j] > level]
    key = F.lit(0).cast("bigint")
    for place, (level, j) in enumerate(places):
        key = key.bitwiseOR(F.shiftleft(F.shiftright(cells[j], level).bitwiseAND(F.lit(1)), place))
    return key
