"""Secret scan with a trigram inverted index.

For each rule's regular expression a Boolean trigram query is derived: an OR
of ANDs of three-character strings that every match must contain (in lower
case).  The documents are indexed by the trigrams that occur in those
queries; the postings of each clause are intersected by counting; only the
documents that satisfy a rule's query are read again and verified with the
rule itself.  A rule whose expression has no mandatory trigram scans every
text.

Everything runs as DataFrame expressions.  Documents are keyed by 128 bits of
hash over (doc_id, text), and equal rows share one key, so copies are indexed
once.  Two rows with equal hashes and different texts, one chance in 2^128 a
pair, would each get the spans of both.

Defined results: a null text counts as empty and has no spans; an empty table
gives an empty result; repeated rows each get their own result row.  ``redact``
of a text takes time with the square of its number of spans.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPAN, Rule, located, masked, matches, no_spans, stored


# The kinds of secrets and their shapes, in the order of output.
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", _ASSIGN, lambda hit: F.length(F.regexp_extract(hit, _ASSIGN, 2)) >= 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
_MAX_ALTERNATIVES = 64


def _finite(seq) -> list[str] | None:
    """All strings that ``seq`` matches, if they are few."""
    segments = _segments(seq)
    return segments[0] if len(segments) == 1 else None


def _segments(seq) -> list[list[str]]:
    """Stretches every match contains in turn, each as its alternatives."""
    done, now = [], [""]

    def cut() -> None:
        nonlocal now
        done.append(now)
        now = [""]

    for op, arg in seq:
        choice: list[str] | None = None
        if op is sre.LITERAL:
            choice = [chr(arg)]
        elif op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg) and len(arg) <= 6:
            choice = [chr(c) for _, c in arg]
        elif op is sre.SUBPATTERN:
            choice = _finite(arg[-1])
        elif op is sre.BRANCH:
            parts = [_finite(b) for b in arg[1]]
            choice = None if None in parts else [s for p in parts for s in p]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            some = _finite(inner)
            if (low, high) == (0, 1) and some is not None:
                choice = ["", *some]
            elif low and low == high and some is not None:
                choice = ["".join(x) for x in product(some, repeat=low)] if len(some) ** low <= _MAX_ALTERNATIVES else None
        if choice is None or len(now) * len(choice) > _MAX_ALTERNATIVES:
            cut()
            if op is sre.SUBPATTERN:
                done.extend(_segments(arg[-1]))
        else:
            now = [a + b for a in now for b in choice]
    done.append(now)
    return done


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The pattern's query as an OR of trigram sets; None if any text may match."""
    clauses = [frozenset()]
    for segment in _segments(sre_parser.parse(pattern)):
        grams = [frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in segment]
        # a further AND only narrows the search, so one too wide is left out
        if all(grams) and len(clauses) * len(grams) <= 4 * _MAX_ALTERNATIVES:
            clauses = [a | b for a in clauses for b in grams]
    least = [c for c in set(clauses) if not any(d < c for d in clauses)]
    return None if frozenset() in least else sorted(least, key=sorted)


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    d, t = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.xxhash64(F.lit(0), d, t).alias("h1"), F.xxhash64(F.lit(1), d, t).alias("h2"),
                       d.alias("doc_id"), t.alias("text"))


def index(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: h1, h2, doc_id, grams (those of the queries that
    occur in it) and ``scanned``, the spans of the rules without a query."""
    grams = sorted({g for r in rules for c in trigram_query(r.pattern) or () for g in c})
    full = [(i, r) for i, r in enumerate(rules) if trigram_query(r.pattern) is None]
    low = _keyed(docs, text, doc_id).withColumn("low", F.lower("text"))
    held = [F.when(F.contains(F.col("low"), F.lit(g)), F.lit(g)) for g in grams]
    marked = low.withColumns({"grams": F.array_compact(F.array(*held)) if held else F.array().cast("array<string>")}
                             | matches(F.col("text"), full))
    return marked.select("h1", "h2", "doc_id", "grams", located(F.col("text"), full).alias("scanned"))


def candidates(indexed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """h1, h2, ranks: the rules whose Boolean query the document satisfies."""
    spark = indexed.sparkSession
    terms = [(rank, k, len(clause), g) for rank, r in enumerate(rules)
             for k, clause in enumerate(trigram_query(r.pattern) or ()) for g in sorted(clause)]
    asked = spark.createDataFrame(terms, "rank int, clause int, need int, gram string")
    postings = indexed.select(F.explode("grams").alias("gram"), "h1", "h2").distinct()
    met = (postings.join(F.broadcast(asked), "gram")  # one row per rule, clause and trigram
           .groupBy("h1", "h2", "rank", "clause", "need").count().filter("count = need"))
    return met.groupBy("h1", "h2").agg(F.collect_set("rank").alias("ranks"))


def _scan(docs: DataFrame, rules: Sequence[Rule], text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    indexed = stored(index(docs, rules, text, doc_id), "trigram-index")
    asked = stored(candidates(indexed, rules), "candidates")
    gated = [(i, r) for i, r in enumerate(rules) if trigram_query(r.pattern) is not None]
    texts = _keyed(docs, text, doc_id).select("h1", "h2", "text").join(asked, ["h1", "h2"])
    marked = texts.withColumns(matches(F.col("text"), gated, F.col("ranks")))
    verified = marked.select("h1", "h2", located(F.col("text"), gated).alias("checked")).filter(F.size("checked") > 0)
    return indexed, stored(verified.dropDuplicates(["h1", "h2"]), "verified")


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, spans (start, kind's rank, end, kind)."""
    indexed, verified = _scan(docs, rules, text, doc_id)
    both = F.concat(F.col("scanned"), F.coalesce(F.col("checked"), no_spans()))
    return indexed.drop("grams").join(verified, ["h1", "h2"], "left").select(
        "doc_id", F.array_sort(both).cast(SPAN).alias("spans"))


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with each secret replaced by its kind; other columns and rows
    as they are.  A null text stays null."""
    indexed, verified = _scan(docs, rules, text, doc_id)
    scanned = indexed.filter(F.size("scanned") > 0).select("h1", "h2", "scanned").dropDuplicates(["h1", "h2"])
    spans = stored(scanned.join(verified, ["h1", "h2"], "full").select("h1", "h2", F.concat(
        F.coalesce("scanned", no_spans()), F.coalesce("checked", no_spans())).alias("spans")), "spans")
    d, t = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.xxhash64(F.lit(0), d, t).alias("h1"), F.xxhash64(F.lit(1), d, t).alias("h2"),
                       F.struct("*").alias("row")).join(spans, ["h1", "h2"], "left")
    was = F.col(f"row.`{text}`")
    clean = F.when(F.size("spans") > 0, masked(was, F.col("spans"))).otherwise(was)
    return rows.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
