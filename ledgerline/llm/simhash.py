"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint is eight bytes.  Fingerprints that differ in at most ``k`` bits
(k < 8) differ in at most k bytes, so they share at least 8 - k bytes at equal
positions: the guaranteed minimum.  The index has a posting list for each
choice of that many positions and their byte values; a pair meets there
exactly when its tally of shared positional bytes reaches the minimum.  (Lists
of single bytes would hold 1/256 of all fingerprints each, and tallying pairs
over them would be quadratic; these lists are the intersections that the
count filter would keep.)  A pair that meets in several lists is taken in the
first one, and verified by its Hamming distance.

At scale: equal fingerprints are merged first, so copies cost one posting set.
A list is read in a stream, sorted by key; one that is longer than ``BLOCK``
is written out in blocks and compared by pairs of blocks in tasks of their
own, so no task holds an unbounded list and no pair is lost.  Each task hands
on a spanning forest of the links it verified, not the links.

Defined results: null and empty texts have fingerprint zero and are linked
like any others; fewer words than a shingle make one shingle; repeated rows
each get a result; a null doc_id never is a component's id unless all its
members' ids are null; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, stored, with_row_ids
from ledgerline.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096
_CHUNK = 1 << 16


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text in UTF-8, as an unsigned integer."""
    words = raw.lower().split()  # of bytes: A-Z and white space of ASCII only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = (ends - sizes)[:n], ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(first[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """rid, doc_id, text -> rid, doc_id, fp (the 64 bits as a long)."""
    schema = rows.select("rid", "doc_id").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(raw, shingle) for raw in batch["raw"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["rid"], batch["doc_id"], pa.array(fps)], ["rid", "doc_id", "fp"])

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    return map_arrow(rows.select("rid", "doc_id", raw), run, schema)


def _choices(max_bits: int) -> list[tuple[int, ...]]:
    return list(combinations(range(8), 8 - max_bits))


def _postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """fp -> list, fp: one row for each choice of positions."""
    choices = _choices(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            parts = fp.view(np.uint8).reshape(-1, 8).astype(np.int64)
            for number, choice in enumerate(choices):
                key = np.full(len(fp), number, np.int64)
                for position in choice:
                    key = (key << 8) | parts[:, position]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], ["list", "fp"])

    return map_arrow(fps.select("fp"), run, "list long, fp long")


def _verified(a: np.ndarray, b: np.ndarray, number: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs are links, each in the first list where it meets."""
    differ = a ^ b
    close = np.flatnonzero(np.bitwise_count(differ.view(np.uint64)) <= max_bits)
    equal = differ[close].view(np.uint8).reshape(-1, 8) == 0
    tally = equal.sum(1)
    least = 8 - max_bits
    first = equal & (np.cumsum(equal, 1) <= least)
    names = {sum(1 << p for p in c): i for i, c in enumerate(_choices(max_bits))}
    place = np.full(256, -1)
    place[list(names)] = list(names.values())
    mine = place[np.packbits(first, axis=1, bitorder="little")[:, 0]] == number[close]
    return close[(tally >= least) & mine]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node linked with it."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within runs of equal keys (sorted)."""
    width = 8 * (8 - max_bits)
    found_a, found_b = [], []
    left, step = np.arange(len(key)), 1
    while True:
        left = left[left + step < len(key)]
        left = left[key[left] == key[left + step]]
        if not len(left):
            break
        for at in range(0, len(left), _CHUNK):
            i = left[at:at + _CHUNK]
            good = i[_verified(fp[i], fp[i + step], key[i] >> width, max_bits)]
            found_a.append(fp[good])
            found_b.append(fp[good + step])
        step += 1
    if not found_a:
        return fp[:0], fp[:0]
    return _forest(np.concatenate(found_a), np.concatenate(found_b))


_FOUND = "list long, block int, a long, b long"


def _found(key, block, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(block, pa.int32()), pa.array(a, pa.int64()),
                                       pa.array(b, pa.int64())], ["list", "block", "a", "b"])


def _streamed(max_bits: int, block: int):
    """Over postings sorted by list: links as (null, null, a, b); the members
    of lists longer than ``block`` as (list, block number, fp, null)."""
    def linked(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = _links(key, fp, max_bits)
        return _found([None] * len(a), [None] * len(a), a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.zeros(0, np.int64)
        long_list, seen = None, 0  # a list being written out, and how much of it
        for batch in batches:
            key = np.concatenate([key, batch["list"].to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch["fp"].to_numpy(zero_copy_only=False)])
            if long_list is not None:
                n = int(np.searchsorted(key, long_list, "right"))
                yield _found(key[:n], (seen + np.arange(n)) // block, fp[:n], [None] * n)
                key, fp, seen = key[n:], fp[n:], seen + n
            if not len(key):
                continue
            long_list = None
            last = int(np.searchsorted(key, key[-1], "left"))
            if last:
                yield from whole(key[:last], fp[:last])
            key, fp = key[last:], fp[last:]
            if len(key) > block:
                long_list, seen = int(key[0]), len(key)
                yield _found(key, np.arange(seen) // block, fp, [None] * seen)
                key = fp = np.zeros(0, np.int64)
        if len(key):
            yield from whole(key, fp)

    def whole(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, start, size = np.unique(key, return_index=True, return_counts=True)
        for at, n in zip(start[size > block].tolist(), size[size > block].tolist()):
            yield _found(key[at:at + n], np.arange(n) // block, fp[at:at + n], [None] * n)
        several = np.repeat((size > 1) & (size <= block), size)
        if several.any():
            yield linked(key[several], fp[several])

    return run


def _block_pairs(members: DataFrame, max_bits: int) -> DataFrame:
    """Links of the long lists: each pair of blocks is one small group."""
    last = members.groupBy("list").agg(F.max("block").alias("last"))
    paired = members.join(last, "list").select("list", "block", "fp", F.explode(
        F.sequence(F.lit(0), "last")).alias("other")).select(
        "list", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp")

    def run(table: pa.Table) -> pa.Table:
        key, block = table["list"][0].as_py(), table["block"].to_numpy()
        i = table["i"][0].as_py()
        fp = table["fp"].to_numpy()
        x, y = fp[block == i], fp[block != i]
        inside = not len(y)
        y = x if inside else y
        number = np.full(len(y), key >> (8 * (8 - max_bits)))
        found = [(np.full(len(good), v), y[good]) for n, v in enumerate(x)
                 if len(good := _verified(np.full(len(y), v), y, number, max_bits))]
        a, b = _forest(*map(np.concatenate, zip(*found))) if found else (fp[:0], fp[:0])
        return pa.table({"a": a, "b": b})

    return paired.groupBy("list", "i", "j").applyInArrow(run, "a long, b long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> edges a, b that connect every two
    fingerprints within ``max_bits`` bits, directly or by way of others."""
    if not 0 <= max_bits < 8:
        raise ValueError("the index needs 0 to 7 bits")
    sorted_lists = _postings(fps, max_bits).repartition("list").sortWithinPartitions("list")
    found = stored(map_arrow(sorted_lists, _streamed(max_bits, block), _FOUND), "links")
    near = found.filter("list IS NULL").select("a", "b")
    members = found.filter("list IS NOT NULL").select("list", "block", F.col("a").alias("fp"))
    return near if members.isEmpty() else near.unionByName(_block_pairs(members, max_bits))


def link_rows(rows: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """rid, doc_id, text -> rid, doc_id, fp, keep_rid, component_id."""
    marked = stored(fingerprints(rows, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    fps = stored(marked.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = components(links(fps, max_bits, block))
    placed = fps.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    # stored, so that the join's inputs are plain shuffles and a large component can be split
    heads = stored(placed.groupBy("root").agg(F.min("first").alias("head")), "heads")
    named = stored(placed.select("fp", "root").join(heads, "root").select(
        "fp", F.col("head.rid").alias("keep_rid"), F.col("head.doc_id").alias("component_id")), "components")
    return marked.join(named, "fp").select("rid", "doc_id", "fp", "keep_rid", "component_id")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{doc_id}`").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    return link_rows(rows, shingle, max_bits, block).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id."""
    rows = with_row_ids(docs, text, doc_id)
    kept = link_rows(rows.select("rid", "doc_id", "text"), shingle, max_bits).filter("rid = keep_rid").select("rid")
    return rows.select("rid", "row").join(kept, "rid", "left_semi").select("row.*")
