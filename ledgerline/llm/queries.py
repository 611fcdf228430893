"""Registered queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    attention_lm, bitpack, exact_dedup, filter_audit, jaccard_join, licenses, packing, pii, quality, secret_scan,
    sentencepieces, simhash, tokens, word_runs,
)
from ledgerline.llm.common import SPACE_RUN, bound, count_kind, documents, spans_text
from ledgerline.oracle import CRC_TABLE, crc32_sql


def op1_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.packed_ids(documents(spark, sf_dir).select("doc_id", "text"),
                              tokens.tokenizer_path(tokens.BYTE_BPE), tokens.BYTE_BPE_IDS, end_id=2)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(documents(spark, sf_dir).select("doc_id", "text"),
                                        tokens.tokenizer_path(tokens.BYTE_BPE))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.packed(documents(spark, sf_dir).select("doc_id", "text"),
                                          tokens.tokenizer_path(tokens.WORD_BPE), end_id=1))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = quality.assess(documents(spark, sf_dir).select("doc_id", "text"))
    return seen.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(pii.scan(documents(spark, sf_dir).select("doc_id", "text")), ["email", "ip", "card", "phone"])


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text; the digest is that of the decoded text."""
    model = sentencepieces.Model(sentencepieces.read_vocabulary(tokens.tokenizer_path(sentencepieces.PIECES_FILE)))
    back = sentencepieces.decode(sentencepieces.encode(documents(spark, sf_dir).select("doc_id", "text"), model), model)
    return back.select("doc_id", "n_pieces", "n_bytes", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir).select("doc_id", "text"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir).select("doc_id", "text")).drop("detections")


def _span_digest(found: DataFrame, base: list[str]) -> DataFrame:
    spans = F.col("spans")
    return found.select(
        "doc_id", *[count_kind(spans, k).alias(f"n_{k}") for k in base],
        F.sha2(spans_text(F.filter(spans, lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text")), ["assign", "access", "hex"])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir).select("doc_id", "text"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the texts, by the crc32 of their id, turn
    periodic from some word on (a null id: never)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", SPACE_RUN), lambda w: w != "")

    def turned(ws):
        n = F.size(ws).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(ws, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))), " ")

    planted = (F.pmod(h, F.lit(10)) == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(planted, bound(words, turned)).otherwise(F.col("text")).alias("text"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.word_runs(with_planted_runs(documents(spark, sf_dir).select("doc_id", "text")))
    longest = F.get(F.array_sort("runs", lambda x, y: F.coalesce(
        F.nullif(F.signum(y["length"] - x["length"]), F.lit(0.0)), F.nullif(F.signum(x["start"] - y["start"]), F.lit(0.0)),
        F.signum(x["period"] - y["period"])).cast("int")), 0)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", longest.alias("top")).select(
        "doc_id", "n_runs", "top.*", F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.filter_audit(documents(spark, sf_dir).select("doc_id", "text", "source"), labels)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(documents(spark, sf_dir).select("doc_id", "text"))


def _found_sql(rules: list[tuple[str, str, str]], base: list[str]) -> str:
    """Spans as SQL: rules are (kind, RE2 pattern, condition on the match h)."""
    def one(rank: int, kind: str, pattern: str, keep: str) -> str:
        p = "'" + pattern.replace("'", "''") + "'"
        return f"""
        SELECT doc_id, {rank} AS rank, '{kind}' AS kind, e - length(h) AS s, e FROM (
          SELECT doc_id, h, sum(length(h) + length(p)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS e FROM (
            SELECT doc_id, unnest(range(len(hs))) AS i, unnest(hs) AS h, unnest(ps[:len(hs)]) AS p FROM (
              SELECT doc_id, regexp_extract_all(t, {p}) AS hs, string_split_regex(t, {p}) AS ps FROM d))) WHERE {keep}"""
    inside = ", ".join(f"'{k}'" for k in base)
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)
    text = "string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank)"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        x AS ({" UNION ALL ".join(one(i, *r) for i, r in enumerate(rules))}),
        y AS (SELECT doc_id, {counts}, {text} FILTER (kind IN ({inside})) AS b, {text} AS spans FROM x GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)}, sha256(coalesce(b, '')) AS base_sha256,
          coalesce(spans, '') AS spans FROM d LEFT JOIN y USING (doc_id)"""


def _secret_sql() -> str:
    assign = secret_scan.RULES[0].pattern.replace("'", "''")
    keep = {"assign": f"length(regexp_extract(h, '{assign}', 2)) >= 6"}
    return _found_sql([(r.kind, r.pattern, keep.get(r.kind, "true")) for r in secret_scan.RULES], ["assign", "access", "hex"])


def _quality_sql() -> str:
    names = ", ".join(quality.RULES)
    rounds = [f"m0 AS (SELECT {', '.join(f'CAST({v} AS DOUBLE) AS {k}' for k, v in quality.START.items())})"]
    for i in range(quality.ROUNDS):
        rounds.append(f"m{i + 1} AS (SELECT {', '.join(f'{q} AS {k}' for k, q in quality.update_sql().items())} FROM"
                      f" (SELECT pat.*, {quality.posterior_sql(None, f'm{i}.')} AS p FROM pat, m{i}))")
    white = r"[\x20\x09-\x0D]"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{white}+'), lambda x: x <> '') AS ws,
          list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
        g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
        c AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
        r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM c, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
        f AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
          length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
          len(list_filter(ws, lambda x: trim(x, '{quality.MARKS}') = '')) AS n_wordless,
          length(regexp_replace(t, '[^\\pL]+', '', 'g')) AS n_letters,
          len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
          len(list_distinct(ws)) AS n_distinct, len(regexp_extract_all(t, '[.!?]{white}')) AS n_ends
          FROM w LEFT JOIN r USING (doc_id)),
        v AS (SELECT *, {quality.BASE_FAILED} AS base_failed, {', '.join(f'{q} AS {k}' for k, q in quality.RULES.items())} FROM f),
        pat AS (SELECT {names}, count(*) AS n FROM v GROUP BY {names}),
        {', '.join(rounds)}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
          NOT base_failed AND {quality.posterior_sql(None, 'm.')} >= {quality.KEEP_FROM} AS kept FROM v, m{quality.ROUNDS} AS m"""


def _runs_sql() -> str:
    """Runs as islands of equal words q apart.  A run has at least 6 equal
    words in a row, so pairs of equal 6-grams meet first."""
    grams = " || ' ' || ".join(f"ws[i + {k}]" for k in range(1, 7))
    return rf"""
        WITH c AS (SELECT {CRC_TABLE} AS crc_table),
        d AS (SELECT row_number() OVER () AS r, doc_id, {crc32_sql("doc_id::VARCHAR")} AS h,
          list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS os FROM documents, c),
        e AS (SELECT *, len(os) AS n, CASE WHEN len(os) > 0 THEN (h // 10) % len(os) END AS a FROM d),
        w AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
          os[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE os END AS ws FROM e),
        g AS (SELECT r, i, {grams} AS g FROM (SELECT r, ws, unnest(range(n - 5)) AS i FROM w)),
        p AS (SELECT x.r, y.i - x.i AS q, y.i AS i FROM g AS x JOIN g AS y ON x.r = y.r AND x.g = y.g AND x.i < y.i),
        t AS (SELECT r, q, min(i) AS i, max(i) + 6 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM p)
          GROUP BY r, q, k),
        u AS (SELECT r, i - q AS start, e - i + q AS length, min(q) AS period FROM t
          WHERE e - i + q >= greatest(12, 2 * q) GROUP BY r, start, length),
        z AS (SELECT r, count(*) AS n_runs, arg_max({{'s': start, 'l': length, 'p': period}}, (length, -start, -period)) AS top,
          string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM u GROUP BY r),
        x AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
        v AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM
          (SELECT r, unnest(ws) AS word, unnest(range(n)) AS i FROM w) AS o ANTI JOIN x USING (r, i) GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.l::BIGINT AS length, top.p::BIGINT AS period,
          (1000 * top.l // top.p)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
          sha256(coalesce(kept, '')) AS collapsed_sha256 FROM w LEFT JOIN z USING (r) LEFT JOIN v USING (r)"""


def _audit_sql() -> str:
    letters = "(SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x)"
    return rf"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
          CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
          || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END
          || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
          || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), doc_id IS NULL AND min(doc_id) OVER (PARTITION BY t) IS NOT NULL)
             THEN 'E' ELSE '' END AS fails FROM w LEFT JOIN l USING (doc_id)),
        m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS ng, count(*) FILTER (toxic) AS nt FROM f GROUP BY part, fails),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM {letters} a, {letters} b, {letters} c, {letters} d, {letters} e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT filter_order, step, filter_order[step] AS x, filter_order[:step - 1] AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
        r AS (SELECT *, translate(fails, before, '') = fails AS reached, contains(fails, x) AS fail FROM m, s),
        y AS (SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (reached AND NOT fail), 0) AS kept,
          coalesce(sum(n) FILTER (reached AND fail), 0) AS removed, coalesce(sum(n) FILTER (NOT reached AND fail), 0) AS redundant,
          coalesce(sum(n) FILTER (fails = x), 0) AS unique_fails, coalesce(sum(ng) FILTER (reached AND fail), 0) AS good_lost,
          coalesce(sum(nt) FILTER (reached AND fail), 0) AS toxic_lost FROM r GROUP BY part, filter_order, step, x)
        SELECT part, filter_order, step, {", ".join(f"{c}::BIGINT AS {c}" for c in (
            "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
          (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM y"""


QUERIES = {
    "op1_packed_ids": op1_packed_ids,
    "op2_lm_scores": op2_lm_scores,
    "op3_packing": op3_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_pii": op5_pii,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_simhash": op7_simhash,
    "op8_license_scan": op8_license_scan,
    "op9_secret_scan": op9_secret_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_word_runs": op11_word_runs,
    "op12_filter_audit": op12_filter_audit,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLE = {
    "op4_quality_rules": _quality_sql(),
    "op9_secret_scan": _secret_sql(),
    "op11_word_runs": _runs_sql(),
    "op12_filter_audit": _audit_sql(),
    "op10_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
        g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.h AS text_sha256 FROM t JOIN g USING (h)""",
}
