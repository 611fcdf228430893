"""Interaction audit of document filters by truth-table survival words.

A document's failures are a mask of k <= 5 filters.  Its survival word has one
bit for each of the 2^k subsets of filters: the bit is set if the document
survives that subset, whatever the order.  Positional popcounts of the words
of a part (how many have bit s set, for every s) are the survivors of every
subset.  They are taken with carry-save adders: three words become a word of
sums and a word of carries, bit for bit, until at most two words of each weight
are left.  From the survivors of the subsets follow, for each order of the
filters and each step, what the step keeps, removes, finds removed already, and
each filter's Shapley total.

At scale: a batch of documents becomes 2^k counts for each part in it, so a
part that holds a third of all rows is added up where it lies; what is
shuffled then is counts.  The first copy of a text is found by its SHA-256:
minima are combined map-side, and documents meet them on (digest, doc_id), a
key that copies don't share.

Defined results: null and empty texts are equal, fail A, and are copies of each
other; a null part is the empty string; a null doc_id comes after all others
and has no labels; rows repeated with one doc_id don't make each other copies;
a document counts as labelled if any label row of its doc_id says so; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, stored

FILTERS = "ABCDE"
MIN_WORDS = 200
COUNTS = ("kept", "good", "toxic")
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that don't begin a code point


def survival_words(k: int) -> np.ndarray:
    """Failure mask -> word whose bit s is set if mask and subset s are disjoint."""
    masks, subsets = np.arange(1 << k, dtype=np.uint32)[:, None], np.arange(1 << k, dtype=np.uint32)
    return (((masks & subsets) == 0).astype(np.uint32) << subsets).sum(1, dtype=np.uint32)


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set."""
    counts, pile, weight = np.zeros(32, np.int64), words.astype("<u4"), 1
    while len(pile):
        carries = [pile[:0]]
        while (third := len(pile) // 3):
            a, b, c = pile[:third], pile[third:2 * third], pile[2 * third:3 * third]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            pile = np.concatenate([odd ^ c, pile[3 * third:]])
        bits = np.unpackbits(pile.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        counts += weight * bits.sum(0, dtype=np.int64)
        pile, weight = np.concatenate(carries), 2 * weight
    return counts


def _mask(raw: bytes) -> int:
    """Failures of A to D as bits 0 to 3."""
    words = raw.split()
    n, points = len(words), len(raw.translate(None, _CONTINUED))
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    return (n < MIN_WORDS) | (100 * len(set(words)) < 50 * n) << 1 | (100 * capitals > 2 * points) << 2 | (
        len(raw.translate(None, _SYMBOLS)) < len(raw)) << 3


def failures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """One row per document: doc_id, part, mask of its failures (A lowest)."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("raw"))
    schema = slim.select("doc_id", "part", F.lit(0).alias("mask"), F.col("raw").alias("digest")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["raw"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], pa.array([_mask(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], ["doc_id", "part", "mask", "digest"])

    seen = stored(map_arrow(slim, run, schema), "failures")
    firsts = stored(seen.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True)), "first-copies")
    s, f = seen.alias("s"), firsts.alias("f")
    met = s.join(f, (F.col("s.digest") == F.col("f.digest")) & F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")), "left")
    return met.select("s.doc_id", "s.part", F.when(F.col("f.first"), F.col("s.mask")).otherwise(
        F.col("s.mask").bitwiseOR(F.lit(16))).alias("mask"))


def survivors(flagged: DataFrame, k: int = len(FILTERS)) -> DataFrame:
    """Rows (part, mask, good, toxic) -> part, subset, and how many documents,
    good ones and toxic ones survive the filters of each subset."""
    if not 1 <= k <= 5:
        raise ValueError("a survival word holds the subsets of one to five filters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = survival_words(k)
        for batch in batches:
            coded = batch["part"].dictionary_encode()
            names, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            own = words[batch["mask"].to_numpy(zero_copy_only=False)]
            order = np.argsort(at, kind="stable")
            cuts = np.flatnonzero(np.diff(at[order], prepend=-1, append=len(names)))
            some = {"kept": np.ones(len(own), bool)} | {
                c: batch[c].to_numpy(zero_copy_only=False).astype(bool) for c in COUNTS[1:]}
            for low, high in zip(cuts[:-1], cuts[1:]):
                rows = order[low:high]
                sums = {c: positional_popcounts(own[rows[some[c][rows]]])[:1 << k] for c in COUNTS}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[int(at[rows[0]])].as_py()] * (1 << k), pa.string()), pa.array(range(1 << k), pa.int32()),
                     *(pa.array(sums[c], pa.int64()) for c in COUNTS)], ["part", "subset", *COUNTS])

    partial = map_arrow(flagged.select("part", "mask", "good", "toxic"), run,
                        "part string, subset int, kept long, good long, toxic long")
    return partial.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in COUNTS])


def audit(flagged: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Rows (part, mask, good, toxic) -> one row for each part, order of the
    filters and step."""
    k = len(filters)
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names)
    arrow = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(steps(row["part"], filters, [np.array(row[c]) for c in COUNTS]), arrow)

    tables = survivors(flagged, k).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", *COUNTS))).alias("t"))
    return map_arrow(tables.select("part", *[F.col(f"t.{c}").alias(c) for c in COUNTS]), run, schema)


def steps(part: str, filters: str, left: Sequence[np.ndarray]) -> list[dict]:
    """All orders and steps of one part; ``left`` has the survivors of each
    subset: of all documents, of the good and of the toxic."""
    every, good, toxic = left
    bit, whole = {f: 1 << i for i, f in enumerate(filters)}, (1 << len(filters)) - 1
    out, total = [], dict.fromkeys(filters, 0)
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | bit[f]
            removed = int(every[before] - every[after])
            total[f] += removed
            out.append({"part": part, "filter_order": "".join(order), "step": step, "kept": int(every[after]), "removed": removed,
                        "redundant": int(every[0] - every[bit[f]]) - removed,
                        "unique_fails": int(every[whole & ~bit[f]] - every[whole]),
                        "good_lost": int(good[before] - good[after]), "toxic_lost": int(toxic[before] - toxic[after]), "shapley": f})
            before = after
    for row in out:
        row["shapley"] = total[row["shapley"]]
    return out


def labelled(masks: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows with a mask and a doc_id, with the marks good and toxic."""
    marks = stored(labels.filter(F.col(f"`{doc_id}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")), "marks")
    return masks.join(marks, "doc_id", "left").select(
        "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in COUNTS[1:]])


def filter_audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """The audit of the five filters A to E over ``docs``."""
    return audit(labelled(failures(docs, text, doc_id, part), labels))
