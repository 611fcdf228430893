"""Periodic runs of words by online dyadic square catching.

The words of a text are read one at a time.  Every aligned block of a power
of two words is completed at some word; it gets a name (equal blocks, equal
names; a name is the pair of its halves' names, so nothing rests on hashes) and
becomes a catcher: when the last L words read equal a completed block of L
words that lies 2L to 4L words back, the distance q is a candidate period.
Any square of period q, 2L <= q < 4L, has such a block in its first half, and
only two aligned blocks lie in that distance, so no square is lost and a word
meets at most two catchers a size.  A candidate keeps the stretch of words
equal to those q back: its left end is found by one suffix comparison, and
the appended words advance it until the stretch is q long (a square is
reported) or breaks.  Squares of one period merge into a run, which grows until
a word differs.  Periods one to three are caught by comparing words.

A period that is a multiple of the period of a growing run around it is not a
smallest period and is left out.  Long comparisons use prefix fingerprints and
are checked word by word before a square is reported; if a check fails, the
stretch is measured again word by word.

Defined results: null and empty texts have no words and no run; words keep
their case; repeated rows each get a result; a null doc_id is kept; other
columns are ignored; an empty table gives an empty result.  One text is one
task's work, in n log n steps and memory of about 200 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow

MIN_WORDS = 12
_NEAR = 16
_MODULUS = (1 << 61) - 1
_BASE = 0x1F3D5B79A2C4E687


class _Prefixes:
    """Fingerprints of the prefixes of a growing list, made when asked for."""

    def __init__(self, ids: list[int], modulus: int):
        self.ids, self.modulus = ids, modulus
        self.sums, self.powers = [0], [1]

    def reach(self, n: int) -> None:
        sums, powers, m = self.sums, self.powers, self.modulus
        for x in self.ids[len(sums) - 1:n]:
            sums.append((sums[-1] * _BASE + x + 1) % m)
            powers.append(powers[-1] * _BASE % m)

    def same(self, i: int, j: int, size: int) -> bool:
        """Whether the ``size`` words from i and from j look equal."""
        ids = self.ids
        if size <= _NEAR:
            return ids[i:i + size] == ids[j:j + size]
        self.reach(max(i, j) + size)
        s, p = self.sums, self.powers[size]
        return (s[i + size] - s[i] * p - s[j + size] + s[j] * p) % self.modulus == 0

    def before(self, i: int, j: int) -> int:
        """How many words before i look equal to those before j < i."""
        ids, k = self.ids, 0
        while k < j and k < _NEAR and ids[i - k - 1] == ids[j - k - 1]:
            k += 1
        if k < _NEAR or k == j:
            return k
        low, high = k, j + 1  # same at low, not known to be the same at high
        while high - low > 1:
            mid = (low + high) // 2
            if self.same(i - mid, j - mid, mid):
                low = mid
            else:
                high = mid
        return low


def find_runs(words: Sequence, least: int = MIN_WORDS, modulus: int = _MODULUS) -> list[tuple[int, int, int]]:
    """Maximal runs (start, length, period) of at least max(``least``, twice
    the period) words, by start, then period."""
    ids: list[int] = []
    number: dict = {}
    prefixes = _Prefixes(ids, modulus)
    tables: list[dict] = []   # by size: names of the halves -> name
    ends: list[dict] = []     # by size: end of a named stretch -> name
    blocks: list[list] = []   # by size: names of the completed blocks
    live: dict[int, int] = {}              # period -> start of its growing run
    waiting: dict[int, list[int]] = {}     # period -> start of its stretch, last word compared
    due: dict[int, list[tuple[int, int]]] = {}
    found = []

    def inner(q: int, start: int) -> bool:
        return any(q % p == 0 and at <= start for p, at in live.items())

    def caught(q: int, start: int) -> None:
        waiting.pop(q, None)
        if q not in live and not inner(q, start):
            live[q] = start

    def wait(q: int, start: int, n: int) -> None:
        """The words from ``start`` to n seem to equal those q back."""
        if n - start + 1 < q:
            waiting[q] = [start, n]
            due.setdefault(start + q - 1, []).append((q, start))
        elif ids[start:n + 1] == ids[start - q:n + 1 - q]:
            caught(q, start - q)
        else:  # fingerprints agreed, words do not
            at = n + 1
            while at > start and ids[at - 1] == ids[at - 1 - q]:
                at -= 1
            if at <= n:
                wait(q, at, n)

    def candidate(q: int, at: int, n: int) -> None:
        """The words from ``at`` to n equal a catcher's block q back."""
        if q in live or inner(q, at - q):
            return
        known = waiting.get(q)
        if known is not None:
            seen = known[1]
            if prefixes.same(seen + 1, seen + 1 - q, n - seen):
                known[1] = n
                return
        wait(q, at - prefixes.before(at, at - q), n)

    def reached(q: int, start: int, n: int) -> None:
        """Now the stretch is q words long, unless it broke."""
        known = waiting.get(q)
        if known is None or known[0] != start:
            return
        del waiting[q]
        seen = known[1]
        if prefixes.same(seen + 1, seen + 1 - q, n - seen):
            wait(q, start, n)

    for n, word in enumerate(words):
        x = number.setdefault(word, len(number))
        ids.append(x)
        if live:
            for q in [q for q in live if ids[n - q] != x]:
                found.append((live.pop(q), n, q))
        if n in due:
            for q, start in due.pop(n):
                reached(q, start, n)
        if n and ids[n - 1] == x:
            caught(1, n - 1)
        if n > 2 and ids[n - 2] == x and ids[n - 1] == ids[n - 3]:
            caught(2, n - 3)
        if n > 4 and ids[n - 3] == x and ids[n - 1] == ids[n - 4] and ids[n - 2] == ids[n - 5]:
            caught(3, n - 5)
        name, size, level, left = x, 1, 0, ids[n - 1] if n else None
        while left is not None:
            key = left << 32 | name
            if level == len(tables):
                tables.append({})
                ends.append({})
                blocks.append([])
            name = tables[level].get(key)
            whole = not (n + 1) & (2 * size - 1)
            if name is None:
                if not whole:
                    break
                name = tables[level][key] = len(tables[level])
            size *= 2
            ends[level][n] = name
            done = blocks[level]
            at = n - size + 1
            k = at // size - 2
            if k >= 0:
                if done[k] == name:
                    candidate(at - k * size, at, n)
                if k and done[k - 1] == name:
                    candidate(at - (k - 1) * size, at, n)
            if whole:
                done.append(name)
            left = ends[level].get(n - size)
            level += 1
    n = len(ids)
    found += [(start, n, q) for q, start in live.items()]
    return sorted((start, end - start, q) for start, end, q in found if end - start >= least)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = bytearray(len(words))
    for start, length, q in runs:
        drop[start + q:start + length] = b"\x01" * (length - q)
    return [w for w, gone in zip(words, drop) if not gone]


def word_runs(docs: DataFrame, least: int = MIN_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, runs (array of start, length,
    period, by start, then period) and the collapsed text."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("raw"))
    run_type = "array<struct<start:long,length:long,period:long>>"
    schema = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.lit(0).cast("long").alias("n_words"),
                         F.array().cast(run_type).alias("runs"), F.lit("").alias("collapsed")).schema
    arrow = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, texts = [], [], []
            for raw in batch["raw"].to_pylist():
                words = raw.split()
                got = find_runs(words, least)
                sizes.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in got])
                texts.append(b" ".join(collapsed(words, got)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(runs, arrow), pa.array(texts, pa.binary()).view(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return map_arrow(slim, run, schema)
