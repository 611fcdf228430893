import re
from collections import Counter

from ledgerline.llm import quality
from tests.llm import cases

WHITE = "[\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = [w for w in re.split(WHITE, text) if w]
    lines = [x for x in text.split("\n") if re.sub(WHITE, "", x)]
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    covered = {j for i, t in enumerate(triples) if often[t] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_traits_of_edge_rows(spark):
    data = cases.rows() + [(50, "a b c a b c d a b c", "en", "s", 1), (51, "x x x x", "en", "s", 1), (52, "a b", "en", "s", 1)]
    got = quality.assess(cases.docs(spark, data)).collect()
    want = sorted((str(r[0]), *plain(r[1])) for r in data)
    assert sorted((str(r.row.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def _corpus():
    """Varied prose, texts of symbols, and texts of repeated lines."""
    names = [a + b + c for a in ("ka", "lo", "mi", "ru", "te", "va") for b in ("bor", "den", "fis", "gul") for c in ("a", "en", "ic", "")]
    def prose(i, n):
        return " ".join(names[(i * 31 + j * (7 + i % 5) + j * j) % len(names)] + "xyzwvutsrq"[i * j % 10] + ("." if j % 9 == 8 else "") for j in range(n)) + ". "
    good = [prose(i, 90 + i % 60) for i in range(120)]
    signs = [" ".join(f"{w}{'#$%&'[j % 4] * 4}" for j, w in enumerate(prose(i, 120).replace(".", "").split())) for i in range(20)]
    dull = ["\n".join([prose(i, 12)] * 3 + [prose(i + k, 9) for k in range(5)] * 3) for i in range(20)]
    return good, signs, dull


def test_em_separates_kinds_without_labels(spark):
    good, signs, dull = _corpus()
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(good + signs + dull)]
    got = {r.row.doc_id: r for r in quality.assess(cases.docs(spark, data)).collect()}
    assert sum(got[i].kept for i in range(len(good))) >= len(good) - 1
    assert not any(got[i].kept for i in range(len(good), len(good) + len(signs)))
    assert not any(got[i].kept for i in range(len(good) + len(signs), len(data)))


def test_stage_equals_the_verdict_and_keeps_columns(spark):
    good, signs, dull = _corpus()
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(good[:40] + signs[:8])] + cases.rows()
    verdict = quality.assess(cases.docs(spark, data)).filter("kept").count()
    kept = quality.keep_good(cases.docs(spark, data))
    assert kept.columns == cases.SCHEMA.fieldNames() and kept.count() == verdict
    assert quality.keep_good(cases.docs(spark, [])).count() == 0 and quality.assess(cases.docs(spark, [])).count() == 0
    before = cases.docs(spark, extra=True)
    assert quality.keep_good(before).columns == before.columns


def plain_votes(r):
    """The eight rules in Python, from the traits."""
    def vote(bad, good):
        return -1 if bad else 1 if good else 0

    n = r.n_words
    return {"length": vote(n < 50, n >= 2000), "symbols": vote(10 * r.n_symbols > n, 50 * r.n_symbols <= n),
            "wordless": vote(10 * r.n_wordless > n, 50 * r.n_wordless <= n),
            "letters": vote(4 * r.n_letters < 3 * r.word_chars, 8 * r.n_letters >= 7 * r.word_chars),
            "lines": vote(r.n_dup_lines >= 3 and 10 * r.n_dup_lines > 3 * r.n_lines, r.n_lines > 3 and 10 * r.n_dup_lines <= r.n_lines),
            "repeats": vote(10 * r.n_repeat_words > 3 * n, 20 * r.n_repeat_words <= n),
            "variety": vote(n < 400 and 4 * r.n_distinct < n, 3 * r.n_distinct >= n),
            "sentences": vote(n >= 150 and 60 * r.n_ends < n, 1 <= r.n_ends <= n / 3)}


def plain_posteriors(votes, rounds=12):
    """Two classes; a rule is right about good texts with one accuracy and
    about bad ones with another; abstentions say nothing.  Counts start with
    9 of 10 right on good texts, 7 of 10 on bad ones, 1 of 2 for the prior."""
    prior, good, bad = 0.85, dict.fromkeys(votes[0], 0.98), dict.fromkeys(votes[0], 0.55)

    def posterior(v):
        g, b = prior, 1 - prior
        for rule, said in v.items():
            if said:
                g *= good[rule] if said > 0 else 1 - good[rule]
                b *= bad[rule] if said < 0 else 1 - bad[rule]
        return g / (g + b)

    for _ in range(rounds):
        p = [posterior(v) for v in votes]
        for rule in votes[0]:
            spoke = [(q, v[rule]) for q, v in zip(p, votes) if v[rule]]
            good[rule] = (sum(q for q, said in spoke if said > 0) + 9) / (sum(q for q, _ in spoke) + 10)
            bad[rule] = (sum(1 - q for q, said in spoke if said < 0) + 7) / (sum(1 - q for q, _ in spoke) + 10)
        prior = (sum(p) + 1) / (len(p) + 2)
    return [posterior(v) for v in votes]


def test_votes_and_posteriors_equal_plain_python(spark):
    good, signs, dull = _corpus()
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(good[:60] + signs + dull)] + cases.rows()
    got = quality.assess(cases.docs(spark, data)).collect()
    votes = [plain_votes(r) for r in got]
    assert [{k: r[k] for k in v} for r, v in zip(got, votes)] == votes and set(votes[0]) == set(quality.RULES)
    for r, p in zip(got, plain_posteriors(votes)):
        assert abs(r.quality - p) < 1e-9 and r.kept == (not r.base_failed and p >= 0.5)
    assert {-1, 0, 1} <= {x for v in votes for x in v.values()}
