"""Near-duplicates by a grouped prefix join on sets of word shingles.

Documents with equal words become one class.  Shingles have one global order:
those found frequent last, the others first, each by hash.  Two sets whose
Jaccard similarity reaches the threshold share a shingle among the first
n - ceil(t n) + 1 of each (the prefix).  Classes of equal size and equal prefix
are collapsed into one group, and only groups are posted under their prefix's
shingles.  Pairs of groups that meet in a list are filtered, then expanded into
their members, which are verified on their whole sets.

Filters, none of which loses a link: by position (at the first shingle that
two sets share, what follows in either bounds the overlap; a link passes there,
whatever happens in its later lists), and by parity maps of the frequent and the
other shingles (bits that differ, and shingles before the meeting point, are
shingles that only one set holds).

Lists are worked off in two steps, so that a large family of near copies costs
no pair of each two of its members.  First each group meets the next ``NEXT``
ones of each list, which is every pair of the short lists, and the list's first
two: those with the fewest rare shingles before the meeting point, the middle
of a family.  A group is there for one of its members; the members of a group
meet likewise.  Verified links give components.  Then the lists that are longer
or have a group of several members, and the groups, as far as they hold several
components, give all pairs of members of different components, in blocks of
bounded size.  Pairs inside a component need no look: they are connected already.  So
components are exact.

The order is a matter of speed alone: any function of a shingle's hash gives the
same result.  Shingles are frequent if more than ``FREQUENT`` classes hold them,
counted over all shingles of all classes (16 bytes a distinct value are held by
the task that sums a shuffle partition); if they are more than ``MOST_FREQUENT`` (8 bytes each, the bound of what is broadcast), the limit
doubles until they fit.

Shingles are told apart by 64 bits, texts by 128 and groups by 63; lists by 48 bits, where
equal bits of different shingles give a candidate more, never a link more.

Defined results: null, empty and blank texts have no shingle and are linked with
nothing; fewer words than a shingle are one shingle; repeated rows each get a
result; a null doc_id names a component only if all its members' are null; other
columns are ignored; an empty table gives an empty result.  A very long text is
one row of one task, hashed in stretches, in memory of about 60 bytes a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, maybe_among, stored
from ledgerline.llm.components import components

SHINGLE = 5
PERCENT = 80
FREQUENT = 32
MOST_FREQUENT = 1 << 19
NEXT = 3
BLOCK = 512
_CHUNK = 1 << 18
_STRETCH = 1 << 16
_KEY_BITS = 48

# A shingle's hash is a polynomial over the bytes of its words and spaces, modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([i])) | 1 for i in range(256)], np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, n: int) -> np.ndarray:
    """The first n powers of the base, or of its inverse."""
    if len(_powers[name]) < n:
        base = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, 2 * _STRETCH), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name][:n]


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of lower-case words with one space between, as
    sorted 64-bit hashes."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    first, last = np.append(0, gaps + 1), np.append(gaps, len(raw))
    n = max(1, len(first) - shingle + 1)
    first, last = first[:n], last[min(shingle, len(last)) - 1:]
    out, at = np.zeros(n, np.uint64), 0
    while at < n:  # a stretch of the text, one shingle at least
        end = max(at + 1, int(np.searchsorted(last, first[at] + _STRETCH, "right")))
        low, high = int(first[at]), int(last[end - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[raw[low:high]] * _power("up", high - low), out=sums[1:])
        begin = first[at:end] - low
        out[at:end] = (sums[last[at:end] - low] - sums[begin]) * _power("down", high - low)[begin]
        at = end
    for turn, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out ^= out >> np.uint64(turn)
        out *= np.uint64(factor)
    return np.unique(out ^ out >> np.uint64(31))


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _texts(docs: DataFrame, text: str, doc_id: str, packed: bool) -> DataFrame:
    """doc_id and the key of each document's lower-case words (NULL without
    words), and on demand the words, compressed."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("raw"))
    schema = slim.select("doc_id", *[F.lit(None).cast("long").alias(c) for c in ("t1", "t2")], *(["raw"] if packed else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [b" ".join(raw.lower().split()) for raw in batch["raw"].to_pylist()]  # of bytes: ASCII only
            keys = [xxhash.xxh3_128_intdigest(t) if t else None for t in texts]
            halves = [pa.array([None if k is None else int.from_bytes((k >> s & (1 << 64) - 1).to_bytes(8), signed=True)
                                for k in keys], pa.int64()) for s in (64, 0)]
            more = [pa.array([press.compress(t) for t in texts], pa.binary())] if packed else []
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *halves, *more], names=["doc_id", "t1", "t2"] + ["raw"] * packed)

    return map_arrow(slim, run, schema)


def _classes(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row per distinct text with a word: cid, t1, t2, raw."""
    packed = _texts(docs, text, doc_id, True).filter("t1 IS NOT NULL")
    return stored(packed.groupBy("t1", "t2").agg(F.first("raw").alias("raw"))
                  .withColumn("cid", F.monotonically_increasing_id()), "classes")


def _read(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """Class ids and their sets."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        for cid, raw in zip(batch["cid"].to_pylist(), batch["raw"].to_pylist()):
            yield cid, shingle_set(unpress.decompress(raw), shingle)


def _frequent(classes: DataFrame, shingle: int, frequent: int, most: int) -> tuple[np.ndarray, int]:
    """Sorted leading bits of the frequent shingles, and the shift that takes
    a hash to them: 16 times as many values as there can be shingles."""
    total = classes.agg(F.sum(F.length("raw"))).first()[0] or 0
    shift = np.uint64(max(0, 64 - max(32, int(total).bit_length() + 4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            value, times = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(times)], ["value", "times"])

        parts, held = [], 0
        for _, own in _read(batches, shingle):
            parts.append(own >> shift)
            held += len(own)
            if held > 4 * _CHUNK:
                yield counted(parts)
                parts, held = [], 0
        if held:
            yield counted(parts)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of one partition, whose values are in no other one."""
        held = [[x.to_numpy(zero_copy_only=False) for x in batch.columns] for batch in batches if batch.num_rows]
        if held:
            value, times = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(value, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(value[order]) != 0))
            total = np.add.reduceat(times[order], first)
            often = total > frequent
            yield pa.RecordBatch.from_arrays([pa.array(value[order][first][often]), pa.array(total[often])], ["value", "times"])

    kind = "value long, times long"  # counted by chunks already: a second count before the shuffle would find little
    counts = stored(map_arrow(map_arrow(classes.select("cid", "raw"), run, kind).repartition("value"), summed, kind), "frequent")
    # how many have a count above the limit doubled so often
    sizes = {r.doubled: r.n for r in counts.groupBy(F.floor(F.log2((F.col("times") - 1) / frequent)).alias("doubled"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = frequent
    while sum(n for d, n in sizes.items() if frequent << max(d, 0) >= limit) > most:
        limit *= 2
    kept = counts.filter(F.col("times") > limit).select("value").toArrow()["value"].to_numpy()
    return np.sort(kept.astype(np.uint64)), int(shift)


def _parity(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One bit per residue: whether an odd number of the hashes has it."""
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _posted(classes: DataFrame, shingle: int, percent: int, common: np.ndarray, shift: int) -> DataFrame:
    """Postings and class rows (token, g, at, light, maps).

    A posting has its group under each shingle of the prefix (token, at least
    0), and in ``at`` the shingle's position and the set's size.  A class row
    lists the class (as g) under its group's key, which the token ~key tells
    from a shingle, with the number of shingles that aren't frequent and the
    parity maps of the frequent and of the others."""
    known, by = classes.sparkSession.sparkContext.broadcast(common), np.uint64(shift)
    drop = np.uint64(64 - _KEY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, posts, rows, held = known.value, [], [], 0

        def both() -> pa.RecordBatch:
            token, g, at = (np.concatenate(x) for x in zip(*posts))
            mine = list(zip(*rows))
            blank = pa.nulls(len(token), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(x), pa.array(y, pa.int64())]) for x, y in zip((token, g, at), mine)]
                + [pa.concat_arrays([blank, pa.array(mine[3], pa.int64())]),
                   pa.concat_arrays([pa.nulls(len(token), pa.binary()), pa.array(mine[4], pa.binary())])],
                ["token", "g", "at", "light", "maps"])

        for cid, own in _read(batches, shingle):
            n, late = len(own), np.zeros(len(own), bool)
            if len(often):
                some = own >> by
                late = often[np.minimum(np.searchsorted(often, some), len(often) - 1)] == some
            light, heavy = own[~late], own[late]
            prefix = np.concatenate([light, heavy])[:n - -(-percent * n // 100) + 1]
            g = xxhash.xxh3_64_intdigest(prefix.tobytes(), n) >> 1
            posts.append(((prefix >> drop).astype(np.int64), np.full(len(prefix), g, np.int64), (np.arange(len(prefix)) << 32) + n))
            bits = max(64, 1 << (n - 1).bit_length())
            rows.append((~g, cid, n, len(light), _parity(heavy, bits).tobytes() + _parity(light, bits).tobytes()))
            held += len(prefix)
            if held > _CHUNK:
                yield both()
                posts, rows, held = [], [], 0
        if rows:
            yield both()

    return map_arrow(classes.select("cid", "raw"), run, "token long, g long, at long, light long, maps binary")


def _may_link(at: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets whose first common shingle has these places can still
    overlap as much as the threshold asks."""
    i, j, n, m = at >> 32, other >> 32, at & 0xFFFFFFFF, other & 0xFFFFFFFF
    return (100 + percent) * np.minimum(n - i, m - j) >= percent * (n + m)


_MET = "a long, b long, token long, g long, at long, light long, maps binary"


def _neighbours(postings: DataFrame, percent: int) -> DataFrame:
    """Over lists sorted by position: candidates (a, b) of each member with
    the next ones and with the list's first two, each with ``token`` 0 for
    groups and -1 for classes; the postings of lists that this doesn't cover
    (long ones, and those of two groups or more where one has several members,
    as only one of them was met); and all class rows."""
    lists = postings.repartition("token").sortWithinPartitions("token", "at", "g")
    reach, names = NEXT + 1, ("token", "g", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, before = [np.zeros(0, np.int64)] * 3, np.zeros(0, bool), 0  # the first ``before`` rows were handed on, but are context
        heads = None  # of the list that the held rows begin in: token, and (g, at) of its first two
        for batch in chain(batches, [None]):
            if batch is not None:
                classes = batch.filter(pc.less(batch["token"], 0))
                if classes.num_rows:
                    none = pa.nulls(classes.num_rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([none, none, *(classes[c] for c in (*names, "light", "maps"))],
                                                     ["a", "b", *names, "light", "maps"])
                new = [batch[c].to_numpy(zero_copy_only=False) for c in names]
                # classes of one group post the same rows: one is kept, and whether there are many
                joined = [np.concatenate([h[-1:], x]) for h, x in zip(held, new)]
                other = np.append(True, np.any([x[1:] != x[:-1] for x in joined], axis=0))[:len(joined[0])]
                again = np.append(~other[1:], False)[other]
                if len(many):
                    again[0] |= many[-1]
                held = [np.concatenate([h[:-1], x[other]]) for h, x in zip(held, joined)]
                many = np.concatenate([many[:-1], again])
                if len(held[0]) < _CHUNK:
                    continue
            token, g, at = held
            if not len(token):
                continue
            end = len(token) if batch is None else len(token) - reach
            starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(token))))
            place = np.arange(len(token)) - starts[of]  # in its list, as far as it is held
            hubs = []
            for k in range(2):
                index = np.minimum(starts + k, len(token) - 1)
                hubs.append((g[index].copy(), at[index].copy()))
            if heads is not None and heads[0] == token[0]:
                place[of == 0] += reach + 1  # the list's first rows lie further back
                for k in range(2):
                    hubs[k][0][0], hubs[k][1][0] = heads[1][k]
            left, right, kind = [], [], []

            def meet(i: np.ndarray, g2: np.ndarray, at2: np.ndarray) -> None:
                ok = (g[i] != g2) & _may_link(at[i], at2, percent)
                left.append(np.minimum(g[i], g2)[ok])
                right.append(np.maximum(g[i], g2)[ok])
                kind.append(np.where(token[i] < 0, -1, 0)[ok])

            for step in range(1, reach):
                i = np.arange(before, min(end, len(token) - step))
                i = i[token[i] == token[i + step]]
                meet(i, g[i + step], at[i + step])
            for k in range(2):
                i = before + np.flatnonzero(place[before:end] > NEXT + k)
                meet(i, hubs[k][0][of[i]], hubs[k][1][of[i]])
            wide, long_list = np.flatnonzero(token[:-reach] == token[reach:]), np.zeros(len(token), bool)
            for step in range(reach + 1):
                long_list[wide + step] = True
            for step in range(1, reach):  # a short list has no places further apart
                i = np.flatnonzero((token[:-step] == token[step:]) & (many[:-step] | many[step:]))
                long_list[i] = long_list[i + step] = True
            own = before + np.flatnonzero(long_list[before:end] & (token[before:end] >= 0))
            pairs = np.unique(np.stack([np.concatenate(x) for x in (kind, left, right)]), axis=1)
            blank, absent = pa.nulls(len(own), pa.int64()), pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([blank, pa.array(pairs[1])]), pa.concat_arrays([blank, pa.array(pairs[2])]),
                 pa.concat_arrays([pa.array(token[own]), pa.array(pairs[0])]),
                 *(pa.concat_arrays([pa.array(x[own]), absent]) for x in (g, at)), pa.nulls(len(own) + pairs.shape[1], pa.int64()),
                 pa.nulls(len(own) + pairs.shape[1], pa.binary())], ["a", "b", *names, "light", "maps"])
            if batch is None:
                return
            keep = max(0, end - reach)
            run_of = of[keep]
            heads = (token[keep], [(int(hubs[k][0][run_of]), int(hubs[k][1][run_of])) for k in range(2)]) if keep > starts[run_of] or (
                heads is not None and run_of == 0 and heads[0] == token[0]) else None
            held, many, before = [h[keep:] for h in held], many[keep:], end - keep

    return stored(map_arrow(lists, run, _MET), "neighbours")


def _folded(maps: list[bytes], size: int) -> np.ndarray:
    """Parity maps (two in a row each) as arrays of 64-bit words, folded to
    ``size`` words each."""
    rows = [np.bitwise_xor.reduce(np.frombuffer(m, "<u8").reshape(2, -1, size), axis=1) for m in maps]
    return np.stack(rows) if rows else np.zeros((0, 2, size), np.uint64)


def _across(members: DataFrame, maps: DataFrame, percent: int, block: int) -> DataFrame:
    """Members (token, g, at, root, mixed) of the lists that hold several
    components, and the maps (g, light, maps) -> candidates (a, b) whose
    components differ or are mixed, as far as positions and maps (where there
    are any) let them link."""
    several = stored(members.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("mixed").alias("any"),
                                                  F.count(F.lit(1)).alias("n"))
                     .filter("low <> high OR any").select("token", (F.col("n") > block).alias("long")), "several")
    # in a long list, sizes that may link lie in one size class or in two that adjoin
    step = math.log(100 / percent * (1 + 1e-6))
    own = F.floor(F.log(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))) / F.lit(step))
    kept = ["token", "g", "at", "root", "mixed"]

    def placed_in(c: Column, upper: bool) -> Column:
        return F.struct(c.alias("c"), F.lit(upper).alias("upper"))

    sized = stored(members.join(several, "token").select(*kept, F.explode(F.when(
        F.col("long"), F.array(placed_in(own, False), placed_in(own - 1, True))).otherwise(
        F.array(placed_in(F.lit(0).cast("long"), False)))).alias("x")).select(*kept, "x.c", "x.upper"), "sized")
    blocks = stored(sized.groupBy("token", "c").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("upper")).alias("lower"))
                    .filter("lower > 0 AND n > 1").select("token", "c", F.ceil(F.col("n") / block).alias("blocks")), "blocks")
    placed = sized.join(blocks, ["token", "c"]).withColumn("k", F.pmod(F.xxhash64("g"), F.col("blocks")))
    keys = ["token", "c", "i", "j"]
    columns = [*keys, "k", "g", "at", "root", "mixed", "upper", "light", "maps"]
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "*", F.least("k", "other").alias("i"), F.greatest("k", "other").alias("j")).join(maps, "g").select(*columns)
    sorted_pairs = paired.repartition(*keys).sortWithinPartitions(*keys)
    plain = columns[:-1]

    def found(rows: dict[str, np.ndarray], maps: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        first = rows["k"] == rows["i"]
        x, y = np.flatnonzero(first), np.flatnonzero(~first)
        inside = rows["i"][0] == rows["j"][0]
        if inside:
            y = x
        at, g, root, mixed, upper, light = (rows[c] for c in ("at", "g", "root", "mixed", "upper", "light"))
        good = (root[x][:, None] != root[y]) | (mixed[x][:, None] | mixed[y])
        good &= ~(upper[x][:, None] & upper[y])
        p, q = np.nonzero(good)
        p, q = x[p], y[q]
        ok = (g[p] < g[q]) if inside else (g[p] != g[q])
        ok &= _may_link(at[p], at[q], percent)
        p, q = p[ok], q[ok]
        if len(p):
            has = np.array([m is not None for m in maps])
            size = min((len(m) // 16 for m in maps if m is not None), default=1)
            own = np.zeros((len(maps), 2, size), np.uint64)
            own[has] = _folded([m for m in maps if m is not None], size)
            ok = np.ones(len(p), bool)
            at_once = max(1, _CHUNK // size)
            for low in range(0, len(p), at_once):
                a, b = p[low:low + at_once], q[low:low + at_once]
                differ = np.bitwise_count(own[a] ^ own[b]).sum(2, dtype=np.int64)
                ahead = np.minimum(at[a] >> 32, light[a]) + np.minimum(at[b] >> 32, light[b])
                apart = differ[:, 0] + np.maximum(differ[:, 1], ahead)
                ok[low:low + at_once] = ~(has[a] & has[b]) | (
                    (100 + percent) * apart <= (100 - percent) * ((at[a] & 0xFFFFFFFF) + (at[b] & 0xFFFFFFFF)))
            p, q = p[ok], q[ok]
        return np.minimum(g[p], g[q]), np.maximum(g[p], g[q])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, maps = {c: np.zeros(0, np.int64) for c in plain}, []
        for batch in chain(batches, [None]):
            if batch is not None:
                held = {c: np.concatenate([held[c], batch[c].to_numpy(zero_copy_only=False).astype(held[c].dtype if c not in (
                    "mixed", "upper") else bool)]) for c in plain}
                maps += batch["maps"].to_pylist()
            n = len(maps)
            if not n:
                continue
            change = np.append(True, np.any([held[c][1:] != held[c][:-1] for c in keys], axis=0))
            cuts = np.flatnonzero(change).tolist()
            if batch is None:
                cuts.append(n)
            out = [found({c: held[c][low:high] for c in plain}, maps[low:high]) for low, high in zip(cuts[:-1], cuts[1:])]
            if out:
                pairs = np.unique(np.stack([np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])
            if batch is not None:
                held, maps = {c: held[c][cuts[-1]:] for c in plain}, maps[cuts[-1]:]

    return map_arrow(sorted_pairs, run, "a long, b long")


def _verified(pairs: DataFrame, groups: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs of classes (a, b) that link: first by their parity maps, then by
    their whole sets."""
    ordered = stored(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")

    def beside(rows: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        """The rows with the columns of both classes; of the table only what
        a filter of fixed size lets through is shuffled."""
        wanted = maybe_among(rows.select(F.explode(F.array("a", "b")).alias("cid")), "cid")
        table = table.filter(wanted(F.col("cid")))
        for side, end in (("a", "left"), ("b", "right")):
            rows = rows.join(table.select(F.col("cid").alias(side), *[F.col(c).alias(f"{end}_{c}") for c in columns]), side)
        return rows

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(*(batch[c].to_pylist() for c in ("left_n", "right_n", "left_maps", "right_maps"))):
                size = min(len(x), len(y)) // 16
                x, y = _folded([x, y], size)
                good.append((100 + percent) * int(np.bitwise_count(x ^ y).sum()) <= (100 - percent) * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    likely = stored(map_arrow(beside(ordered, groups, "n", "maps"), near, "a long, b long"), "likely")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress, known = zstandard.ZstdDecompressor(), {}

        def of(cid: int, raw: bytes) -> np.ndarray:
            if cid not in known:
                if len(known) >= 256:
                    known.clear()
                known[cid] = shingle_set(unpress.decompress(raw), shingle)
            return known[cid]

        for batch in batches:
            a, b, left, right = (batch[c].to_pylist() for c in ("a", "b", "left_raw", "right_raw"))
            good = []
            for i, j, x, y in zip(a, b, left, right):
                x, y = of(i, x), of(j, y)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                shared = int((long[at] == short).sum())
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return stored(map_arrow(beside(likely, classes, "raw"), run, "a long, b long"), "links")


def link_classes(classes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT,
                 most: int = MOST_FREQUENT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Classes (cid, raw) -> (cid, n) of all, and (node, root): the components
    of the linked ones (classes without a link don't occur)."""
    if not 1 <= percent <= 100:
        raise ValueError("the similarity is 1 to 100 percent")
    met = _neighbours(_posted(classes, shingle, percent, *_frequent(classes, shingle, frequent, most)), percent)
    groups = met.filter("maps IS NOT NULL").select(
        F.bitwise_not("token").alias("g"), F.col("g").alias("cid"), F.col("at").alias("n"), "light", "maps")
    leaders = stored(groups.groupBy("g").agg(F.min("cid").alias("leader")), "leaders")
    pairs = met.filter("a IS NOT NULL").select("token", "a", "b").distinct()
    led = pairs.filter("token = 0").join(leaders.toDF("a", "x"), "a").join(leaders.toDF("b", "y"), "b").select(
        F.col("x").alias("a"), F.col("y").alias("b"))
    links = _verified(led.unionByName(pairs.filter("token = -1").select("a", "b")), groups, classes, shingle, percent)
    stars = stored(components(links), "stars")

    named = stored(groups.join(stars, F.col("cid") == F.col("node"), "left").select(
        "cid", "g", "n", F.coalesce("root", "cid").alias("root")), "named")
    state = stored(named.groupBy("g").agg(F.min("root").alias("root"), (F.min("root") < F.max("root")).alias("mixed"),
                                          F.count(F.lit(1)).alias("members")), "group-roots")
    lists = met.filter("token >= 0 AND a IS NULL").select("token", "g", "at").join(state.drop("members"), "g")
    several = state.filter("members > 1").select("g")  # a group of one has the maps of its member, the others none
    maps = groups.select("g", "light", "maps").join(several, "g", "left_anti").unionByName(several.select(
        "g", F.lit(0).cast("long").alias("light"), F.lit(None).cast("binary").alias("maps")))
    wide = _across(lists, maps, percent, block).distinct()
    # expand pairs of groups into pairs of their members
    one, two = (named.select(F.col("g").alias(k), F.col("cid").alias(c), F.col("root").alias(r))
                for k, c, r in (("a", "x", "rx"), ("b", "y", "ry")))
    spread = wide.join(one, "a").join(two, "b").filter("rx <> ry").select(F.col("x").alias("a"), F.col("y").alias("b"))
    inner = named.join(state.filter(f"mixed AND members > {NEXT + 1}").select("g"), "g").select(
        F.col("g").alias("token"), F.col("cid").alias("g"), F.col("n").alias("at"), "root", F.lit(False).alias("mixed"))
    of_class = groups.select(F.col("cid").alias("g"), "light", "maps")
    more = _verified(spread.unionByName(_across(inner, of_class, percent, block)), groups, classes, shingle, percent)
    sizes = groups.select("cid", "n")
    if more.isEmpty():
        return sizes, stars
    return sizes, components(more.unionByName(stars.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id",
                **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id that links reach; the document's own if it has no link)."""
    classes = _classes(docs, text, doc_id)
    marked = stored(_texts(docs, text, doc_id, False), "texts")
    least: Column = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id"))
    firsts = stored(marked.filter("t1 IS NOT NULL").groupBy("t1", "t2").agg(least.alias("first")), "firsts")
    sizes, roots = link_classes(classes.select("cid", "raw"), shingle, percent, **options)
    placed = stored(classes.select("cid", "t1", "t2").join(sizes, "cid").join(firsts, ["t1", "t2"]).join(
        roots, F.col("cid") == F.col("node"), "left").select("t1", "t2", "n", "first", F.coalesce("root", "cid").alias("root")), "placed")
    heads = stored(placed.groupBy("root").agg(F.min("first").alias("head")), "heads")
    named = stored(placed.join(heads, "root").select("t1", "t2", "n", F.col("head.doc_id").alias("component_id")), "components")
    return marked.join(named, ["t1", "t2"], "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_shingles"),
        F.when(F.col("n").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
