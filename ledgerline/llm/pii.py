"""Personal data: patterned entities, and the terms that reveal them.

Entities (e-mail, IP address, card, phone) are found by their patterns.  A
text may still disclose an entity by its other words.  So every term of every
document with a mention is weighed by what the corpus says: with counts n of
distinct documents,

    disclosure(t, e) = PMI(t; e) / IC(e)
                     = 1 - log(n(t) / n(t with e)) / log(N / n(e)),

the share of the entity's information that the term gives away: 1 when it
never occurs without the entity, 0 when the two are independent.  A term is
judged by the entity it discloses most of: from ``GENERALISE_FROM`` it is
replaced by its class, from ``REMOVE_FROM`` it is removed, wherever it occurs,
in documents without a mention too.  Every pair is weighed, those of entities
that occur once as well.  How much a pair's counts say depends on the number k
of different contexts (the text around the mentions) in which it was seen, so
that copies of one text count once: with n(t with e) / n(t) = p,

    p(e | t) = (k p + PRIOR n(e) / N) / (k + PRIOR)

takes its place, which is near independence for a k that is small.  Entities
that occur in the same documents have the same counts and are weighed as one.

All counts are over all documents.  Shuffled are the keys of the rows, the
distinct terms of texts as counts, texts with mentions, and the places of
terms that pass a filter of fixed size for the revealing ones; the texts
themselves only if rows repeat.  All steps are DataFrame expressions.

Defined results: a null text counts as empty and has no spans; repeated rows
each get their result and count once as evidence; an empty table gives an
empty result; other columns are ignored by ``scan`` and kept by ``sanitise``.
Mentions are cut out of a text in time with the square of their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPAN, Rule, blanked, bound, located, matches, maybe_among, no_spans, spans_of, stored


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """The check sum over the digits from the right, every second doubled."""
    def weight(d: Column, i: Column) -> Column:
        twice = 2 * d.cast("int")
        return F.when(i % 2 == 0, d.cast("int")).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    digits = _digits(hit)
    values = F.transform(F.split(F.reverse(digits), ""), weight)
    total = F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.length(digits).between(12, 19) & (total % 10 == 0)


_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# The kinds of entities in the order of output.  The patterns
# match what the plain ones match; possessive repeats and a look behind (or
# the end of the match before) keep long runs of one class linear.
RULES = (
    Rule("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", needs="@"),
    Rule("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda hit: F.rlike(hit, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))),
    Rule("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", _luhn),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda hit: F.length(_digits(hit)).between(9, 15), needs="+"),
)
TERM_RANK = len(RULES)
TERM = r"[\p{L}\p{N}]{3,}"
REACH = 80  # characters on either side of a mention that are its context, which tells copies apart
PRIOR = 2.0  # contexts' worth of independence that a pair starts with
GENERALISE_FROM, REMOVE_FROM = 0.8, 0.95


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    d, t = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.xxhash64(F.lit(0), d, t).alias("h1"), F.xxhash64(F.lit(1), d, t).alias("h2"),
                       d.alias("doc_id"), t.alias("text"))


def _mentions(text: Column, plain: Column, spans: Column) -> Column:
    """For each mention: what it is, and a hash of the text around without mentions."""
    def one(x: Column) -> Column:
        a = F.greatest(x["s"] - REACH, F.lit(0))
        return F.struct(x["kind"].alias("kind"), F.lower(F.substring(text, x["s"] + 1, x["e"] - x["s"])).alias("value"),
                        F.xxhash64(F.substring(plain, a + 1, x["e"] + REACH - a)).alias("seen_in"))
    return F.transform(spans, one)


def entities(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Of each row: h1, h2, the spans and mentions of its entities, and the
    text without them ("plain")."""
    numbered = list(enumerate(RULES))
    keyed = _keyed(docs, text, doc_id).select("h1", "h2", "text")
    found = keyed.withColumns(matches(F.col("text"), numbered)).select(
        "h1", "h2", "text", located(F.col("text"), numbered).alias("spans"))
    plain = found.withColumn("plain", F.when(F.size("spans") > 0, blanked(F.col("text"), F.col("spans"))).otherwise(F.col("text")))
    around = F.when(F.size("spans") > 0, _mentions(F.col("text"), F.col("plain"), F.col("spans")))
    return plain.select("h1", "h2", "plain", "spans", around.alias("mentions"))


def _once(texts: DataFrame) -> DataFrame:
    """The first of the rows that share h1 and h2; only keys are shuffled to
    find the others, and the texts if there are any."""
    keys = texts.select("tid", "h1", "h2")
    several = keys.groupBy("h1", "h2").agg(F.min("tid").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeats = stored(keys.join(several, ["h1", "h2"]).filter("tid <> first").select("tid"), "repeats")
    return texts if repeats.isEmpty() else texts.join(repeats, "tid", "left_anti")


def _hits() -> Column:
    return F.regexp_extract_all("plain", F.lit(TERM), F.lit(0))


def _terms(texts: DataFrame, *also: str) -> DataFrame:
    """One row per distinct term of each text."""
    return texts.select(*also, F.explode(F.array_distinct(F.transform(_hits(), F.lower))).alias("term"))


def disclosures(texts: DataFrame) -> DataFrame:
    """term, disclosure of the terms that occur with an entity, each by the
    entity that it discloses most of."""
    near = texts.filter("mentions IS NOT NULL")
    seen = near.select("tid", "h1", "h2", F.explode("mentions").alias("m")).select("tid", "h1", "h2", "m.*") \
        .groupBy("tid", "h1", "h2", "kind", "value").agg(F.min("seen_in").alias("seen_in"))
    # an entity's documents as a set: their number and two sums of hashes
    sets = seen.groupBy("kind", "value").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"),
                                             F.count(F.lit(1)).alias("n_entity"))
    entity = ["x1", "x2", "n_entity"]
    groups = seen.join(sets, ["kind", "value"]).groupBy("tid", *entity).agg(F.min("seen_in").alias("seen_in"))
    both = _terms(near.join(groups, "tid"), *entity, "seen_in").groupBy(*entity, "term", "seen_in").agg(
        F.count(F.lit(1)).alias("n")).groupBy(*entity, "term").agg(
        F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("contexts"))
    # a frequent term has many entities but few different counts with them
    pairs = both.select("term", "n_entity", "n_both", "contexts").distinct()
    of_term = _terms(texts).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    alone = F.col("n_entity") / F.lit(float(texts.count() + 1))
    share = (F.col("contexts") * F.col("n_both") / F.col("n_term") + PRIOR * alone) / (F.col("contexts") + PRIOR)
    score = 1 - F.log(share) / F.log(alone)
    return pairs.join(of_term, "term").groupBy("term").agg(F.max(score).alias("disclosure"))


def _marked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """h1, h2 and spans (entities and revealing terms) of each distinct row."""
    texts = _once(stored(entities(docs, text, doc_id).withColumn("tid", F.monotonically_increasing_id()), "texts", "zstd"))
    weighed = stored(disclosures(texts).filter(F.col("disclosure") >= GENERALISE_FROM), "disclosures")
    revealing = maybe_among(weighed, "term")
    # each bound: a lambda would split the text anew for every term
    found = bound(F.split("plain", TERM, -1), lambda pieces: bound(_hits(), lambda hits: F.arrays_zip(
        hits.alias("t"), spans_of(hits, pieces, "term", TERM_RANK).alias("x"))))
    places = texts.select("tid", F.explode(found).alias("z")).select(
        "tid", F.lower("z.t").alias("term"), F.col("z.x.s").alias("s"), F.col("z.x.e").alias("e")).filter(revealing(F.col("term")))
    kind = F.when(F.col("disclosure") >= REMOVE_FROM, F.lit("removed")).otherwise(F.lit("general"))
    terms = places.join(weighed, "term").groupBy("tid").agg(F.collect_list(F.struct(
        "s", F.lit(TERM_RANK).alias("rank"), "e", kind.alias("kind"))).cast(SPAN).alias("terms"))
    both = F.array_sort(F.concat("spans", F.coalesce("terms", no_spans()))).cast(SPAN)
    return stored(texts.select("tid", "h1", "h2", "spans").join(terms, "tid", "left").select(
        "h1", "h2", both.alias("spans")), "spans")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, spans of entities and revealing terms
    (kinds "general" and "removed")."""
    return _keyed(docs, text, doc_id).select("h1", "h2", "doc_id").join(
        _marked(docs, text, doc_id), ["h1", "h2"]).select("doc_id", "spans")


def _sanitised(text: Column, spans: Column) -> Column:
    """Entities become their kind, general terms their class; removed ones go."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def instead(x: Column) -> Column:
        number = F.rlike(F.substring(text, x["s"] + 1, x["e"] - x["s"]), F.lit(r"^\p{N}+$"))
        return F.when(x["kind"] == "removed", "").when(x["kind"] != "general", F.concat(
            F.lit("<"), F.upper(x["kind"]), F.lit(">"))).when(number, "<NUMBER>").otherwise("<WORD>")

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["pos"] + 1, x["s"] - acc["pos"])
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"), F.when(x["s"] < acc["pos"], acc["out"]).otherwise(
            F.concat(acc["out"], F.array(gap, instead(x)))).alias("out"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))


def sanitise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with entities and revealing terms replaced; all other columns
    and rows as they are.  A null text stays null."""
    spans = _marked(docs, text, doc_id).filter(F.size("spans") > 0)
    d, t = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.xxhash64(F.lit(0), d, t).alias("h1"), F.xxhash64(F.lit(1), d, t).alias("h2"),
                       F.struct("*").alias("row")).join(spans, ["h1", "h2"], "left")
    was = F.col(f"row.`{text}`")
    clean = F.when(F.size("spans") > 0, _sanitised(was, F.col("spans"))).otherwise(was)
    return rows.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
