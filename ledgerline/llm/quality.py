"""Quality rules combined by weak supervision.

Each rule looks at one trait of a text and votes good (1), bad (-1) or
abstains (0).  No rule decides alone: expectation-maximisation over all
documents estimates, without labels, how often each rule's vote is right for
good and for bad documents, and a document is kept when the posterior
probability of "good" reaches ``KEEP_FROM``.

The model needs only how often each pattern of votes occurs: at most
3^len(RULES) rows whatever the input, so each round is a small aggregate; the
texts are scanned once for the patterns.  All of it is DataFrame expressions.

Defined results: a null text counts as empty (no words, rejected); an empty
table keeps nothing and estimates nothing; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_RUN, bound, stored

# Each rule: name, vote as SQL over the traits (valid in Spark and DuckDB).
RULES = {
    "length": "CASE WHEN n_words < 50 THEN -1 WHEN n_words >= 2000 THEN 1 ELSE 0 END",
    "symbols": "CASE WHEN 10 * n_symbols > n_words THEN -1 WHEN 50 * n_symbols <= n_words THEN 1 ELSE 0 END",
    "wordless": "CASE WHEN 10 * n_wordless > n_words THEN -1 WHEN 50 * n_wordless <= n_words THEN 1 ELSE 0 END",
    "letters": "CASE WHEN 4 * n_letters < 3 * word_chars THEN -1 WHEN 8 * n_letters >= 7 * word_chars THEN 1 ELSE 0 END",
    "lines": "CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN -1"
             " WHEN n_lines > 3 AND 10 * n_dup_lines <= n_lines THEN 1 ELSE 0 END",
    "repeats": "CASE WHEN 10 * n_repeat_words > 3 * n_words THEN -1 WHEN 20 * n_repeat_words <= n_words THEN 1 ELSE 0 END",
    "variety": "CASE WHEN n_words < 400 AND 4 * n_distinct < n_words THEN -1"
               " WHEN 3 * n_distinct >= n_words THEN 1 ELSE 0 END",
    "sentences": "CASE WHEN n_words >= 150 AND 60 * n_ends < n_words THEN -1"
                 " WHEN n_ends BETWEEN 1 AND n_words / 3 THEN 1 ELSE 0 END",
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
KEEP_FROM = 0.5
ROUNDS = 12
# At the start two bad votes outweigh the rest: texts fail in different ways,
# so most rules find nothing wrong with a bad text either.
START = {"prior": 0.85} | {f"{side}_{r}": 0.98 if side == "good" else 0.55 for r in RULES for side in ("good", "bad")}
MARKS = "#*$%&|<>-=_~+.,;:!?/()[]{}"


def _repeat_words(triples: Column) -> Column:
    """Words covered by triples that occur twice or more."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def again(s: Column) -> Column:
        same = F.filter(s, lambda x, k: F.get(s, k - 1)["t"].eqNullSafe(x["t"]) | F.get(s, k + 1)["t"].eqNullSafe(x["t"]))
        return bound(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    ranked = F.array_sort(F.transform(triples, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(triples)) < F.size(triples), bound(ranked, again)).otherwise(0)


def traits(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The traits of each text beside ``row``, its columns (``carry``: some)."""
    t = F.col("t")
    own = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    split = docs.select(own.alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).select(
        "row", "t", F.filter(F.split(t, SPACE_RUN, -1), lambda w: w != "").alias("words"),
        F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias("lines"))
    w, last = F.col("words"), F.size("words") - 3
    triple = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(
        " ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<string>"))
    seen = F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        F.size(F.filter(w, lambda x: F.btrim(x, F.lit(MARKS)) == "")).cast("bigint").alias("n_wordless"),
        F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("bigint").alias("n_letters"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("triples")).cast("bigint").alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
        F.regexp_count(t, F.lit(r"[.!?][\x20\x09-\x0D]")).cast("bigint").alias("n_ends"))
    # made by a generator, so that a filter on what follows from the traits
    # can't be pushed below and compute them again for every mention
    return split.withColumn("triples", triple).select("row", F.inline(F.array(seen)))


def posterior_sql(model: dict[str, float] | None = None, source: str = "") -> str:
    """P(good | votes): parameters as numbers, or as columns of ``source``."""
    def value(k: str) -> str:
        return f"{source}{k}" if model is None else f"CAST('{model[k]!r}' AS DOUBLE)"

    good, bad = [value("prior")], [f"(1 - {value('prior')})"]
    for r in RULES:
        g, b = value(f"good_{r}"), value(f"bad_{r}")
        good.append(f"CASE {r} WHEN 1 THEN {g} WHEN -1 THEN 1 - {g} ELSE 1 END")
        bad.append(f"CASE {r} WHEN 1 THEN 1 - {b} WHEN -1 THEN {b} ELSE 1 END")
    g, b = " * ".join(f"({x})" for x in good), " * ".join(f"({x})" for x in bad)
    return f"({g}) / (({g}) + ({b}))"


def update_sql() -> dict[str, str]:
    """New parameters from rows (votes, n, p): counts smoothed by one, so
    that a rule that never votes on a side keeps a usable accuracy."""
    out = {"prior": "(sum(n * p) + 1) / (sum(n) + 2)"}
    for r in RULES:
        out[f"good_{r}"] = (f"(coalesce(sum(CASE WHEN {r} = 1 THEN n * p END), 0) + 9)"
                            f" / (coalesce(sum(CASE WHEN {r} <> 0 THEN n * p END), 0) + 10)")
        out[f"bad_{r}"] = (f"(coalesce(sum(CASE WHEN {r} = -1 THEN n * (1 - p) END), 0) + 7)"
                           f" / (coalesce(sum(CASE WHEN {r} <> 0 THEN n * (1 - p) END), 0) + 10)")
    return out


def votes(seen: DataFrame) -> DataFrame:
    return seen.withColumns({r: F.expr(f"CAST({sql} AS TINYINT)") for r, sql in RULES.items()})


def fit(voted: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """Expectation-maximisation over the patterns of votes."""
    patterns = stored(voted.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")), "vote-patterns")
    model = dict(START)
    for _ in range(rounds):
        step = patterns.withColumn("p", F.expr(posterior_sql(model)))
        row = step.agg(*[F.expr(sql).alias(k) for k, sql in update_sql().items()]).first()
        model = START if row["prior"] is None else row.asDict()
    return model


def judged(seen: DataFrame, model: dict[str, float]) -> DataFrame:
    """Voted traits with base_failed, quality (the posterior) and kept."""
    return seen.withColumns({"base_failed": F.expr(BASE_FAILED), "quality": F.expr(posterior_sql(model))}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """row (all columns but the text), traits, votes, base_failed, quality and
    kept of each document; the texts are scanned once, their traits stored."""
    seen = stored(votes(traits(docs, text, [c for c in docs.columns if c != text])), "traits")
    return judged(seen, fit(seen))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are.  The texts
    are scanned once; the rows are stored beside their votes, not shuffled."""
    seen = stored(votes(traits(docs, text)), "voted", "zstd")
    return judged(seen, fit(seen)).filter("kept").select("row.*")
