"""Exact duplicates by deterministic block naming.

Each normalised text (runs of white space become one space; null is empty) is
cut into blocks of ``block_bytes`` bytes.  The distinct blocks are sorted and
numbered: a block's number is its name.  Then adjacent names are paired, the
distinct pairs sorted and numbered again, and so on until every document has
one name.  Two documents share (level, name) exactly when their texts are
equal: names stand for contents, never for hashes.

At scale: block contents are shuffled once, for the distinct sort, after
map-side combination, so a block that a third of the documents share reaches
the shuffle once a task.  Names travel back to the documents by a 128-bit
fingerprint which is checked, on the complete set of distinct blocks, to be
one-to-one; if it ever is not, the next seed is taken.  So the result doesn't
rest on chance.  Levels work on triples of integers that halve each time.

Defined results: null and empty text are equal; rows repeated with the same
doc_id form a group like any other and the first stored row stays; a null
doc_id sorts after all others; an empty table gives an empty result; other
columns are carried along by ``keep_first`` and ignored by ``group_equal``.  A
very long text costs time and memory in proportion to its length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_RUN, bound, stored, with_row_ids

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _blocks(text: Column, width: int) -> Column:
    def cut(raw: Column) -> Column:
        last = F.greatest(F.ceil(F.length(raw) / F.lit(width)).cast("int"), F.lit(1)) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * width + 1, F.lit(width)))

    return bound(text.cast("binary"), cut)  # a cast inside the lambda would copy the text for every block


def _fingerprint(block: Column, seed: int, bits: int) -> Column:
    def one(salt: int) -> Column:
        h = F.xxhash64(F.lit(salt), block)
        return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))
    return F.struct(one(2 * seed).alias("a"), one(2 * seed + 1).alias("b"))


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Sort the distinct keys of each partition and number them from 1."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id() + 1)


def _block_names(texts: DataFrame, width: int, seed: int, bits: int) -> DataFrame:
    blocks = texts.select(F.explode(_blocks(F.col("norm"), width)).alias("block")).select(
        _fingerprint(F.col("block"), seed, bits).alias("fp"), "block")
    return stored(_named(blocks.distinct(), ["block"]).select("fp.*", "name"), "block-names")


def identities(rows: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint_bits: int = 64) -> DataFrame:
    """Rows (rid, doc_id, text) -> rid, doc_id, text_sha256, level, name."""
    texts = rows.select("rid", "doc_id", normalised(F.col("text")).alias("norm"))
    seed = 0
    while True:
        names = _block_names(texts, block_bytes, seed, fingerprint_bits)
        if names.groupBy("a", "b").count().filter("count > 1").isEmpty():
            break
        seed, fingerprint_bits = seed + 1, min(64, 2 * fingerprint_bits)
    lean = stored(texts.select(
        "rid", "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(_blocks(F.col("norm"), block_bytes),
                    lambda b: _fingerprint(b, seed, fingerprint_bits)).alias("fps")), "fingerprints")
    spread = lean.select("rid", F.size("fps").alias("n"), F.posexplode("fps").alias("pos", "fp"))
    current = stored(spread.select("rid", "n", "pos", "fp.*").join(names, ["a", "b"])
                     .select("rid", "n", "pos", "name"), "names")
    found, level = [], 0
    while True:
        found.append(current.filter("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        left = current.filter("n > 1")
        if left.isEmpty():
            break
        # an odd last name is paired with 0, which names nothing
        pairs = stored(left.groupBy("rid", "n", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(F.pmod("pos", F.lit(2)) == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.pmod("pos", F.lit(2)) == 1, F.col("name"))), F.lit(0)).alias("r")), "pairs")
        pair_names = stored(_named(pairs.select("l", "r").distinct(), ["l", "r"]), "pair-names")
        current = stored(pairs.join(pair_names, ["l", "r"]).select(
            "rid", F.shiftright(F.col("n") + 1, 1).alias("n"), "pos", "name"), "names")
        level += 1
    # level counts rounds, so equal texts (equal block counts) end on one level
    named = reduce(DataFrame.unionByName, found)
    return lean.select("rid", "doc_id", "text_sha256").join(named, "rid")


def group_equal(rows: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint_bits: int = 64) -> DataFrame:
    """Rows (rid, doc_id, text) -> one row each: rid, doc_id, keep_id,
    group_size, kept, text_sha256."""
    members = stored(identities(rows, block_bytes, fingerprint_bits), "identities")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    groups = stored(members.groupBy("level", "name").agg(
        first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("level", "name", F.col("first.doc_id").alias("keep_id"),
                F.col("first.rid").alias("keep_rid"), "group_size"), "groups")
    return members.join(groups, ["level", "name"]).select(
        "rid", "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 block_bytes: int = BLOCK_BYTES, fingerprint_bits: int = 64) -> DataFrame:
    """One row per document, dropped ones too."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"),
                       F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return group_equal(rows, block_bytes, fingerprint_bits).drop("rid")


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    rows = with_row_ids(docs, text, doc_id)
    kept = group_equal(rows.select("rid", "doc_id", "text"), block_bytes).filter("kept").select("rid")
    return rows.select("rid", "row").join(kept, "rid", "left_semi").select("row.*")
