"""The disclosure of terms against a plain count over a small corpus."""

import math
import random
import re
from collections import defaultdict

from ledgerline.llm import pii
from tests.llm import cases

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
TERM = re.compile(r"[A-Za-z0-9]{3,}")


def corpus(seed):
    """One mention a text at most; some words go with one address only, some
    mostly, and some texts are copies under other ids."""
    rng = random.Random(seed)
    names = [f"user{chr(97 + i)}@host{i}.org" for i in range(9)]
    common = [f"word{chr(97 + i)}" for i in range(18)]
    rows = []
    for i in range(260):
        words = rng.choices(common, k=rng.randrange(12, 40))
        if i % 3 == 0:
            at = rng.randrange(len(names))
            words.insert(rng.randrange(len(words)), names[at] if rng.random() < .5 else names[at].upper())
            words += [f"only{chr(97 + at)}"] * rng.randrange(3) + [f"mostly{chr(97 + at)}"] * (rng.random() < .8)
            words.append(f"Only{chr(97 + at)}" if rng.random() < .2 else "plain")
        elif rng.random() < .04:
            words.append("mostly" + rng.choice("abcdefghi"))
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[3 * i][1]) for i in range(20)] + rows[:9]  # copies, and rows that repeat
    return rows


def plain_terms(rows):
    """Per (doc_id, text): the marked terms as (start, end, kind)."""
    texts, entity_of = sorted(set(rows)), {}
    bare = {}
    for row in texts:
        found = list(EMAIL.finditer(row[1]))
        assert len(found) <= 1
        plain = row[1]
        for m in found:
            plain = plain[:m.start()] + " " * (m.end() - m.start()) + plain[m.end():]
            entity_of[row] = (m[0].lower(), plain[max(m.start() - pii.REACH, 0):m.end() + pii.REACH])
        bare[row] = plain
    terms = {row: {t.lower() for t in TERM.findall(bare[row])} for row in texts}
    n_term, both, contexts, n_entity = defaultdict(int), defaultdict(int), defaultdict(set), defaultdict(int)
    for row in texts:
        for t in terms[row]:
            n_term[t] += 1
        if row in entity_of:
            entity, around = entity_of[row]
            n_entity[entity] += 1
            for t in terms[row]:
                both[entity, t] += 1
                contexts[entity, t].add(around)
    disclosure = defaultdict(float)
    for (entity, t), n in both.items():
        alone, k = n_entity[entity] / (len(texts) + 1), len(contexts[entity, t])
        share = (k * n / n_term[t] + pii.PRIOR * alone) / (k + pii.PRIOR)
        disclosure[t] = max(disclosure[t], 1 - math.log(share) / math.log(alone))
    return {row: sorted((m.start(), m.end(), "removed" if disclosure[m[0].lower()] >= pii.REMOVE_FROM else "general")
                        for m in TERM.finditer(bare[row]) if disclosure[m[0].lower()] >= pii.GENERALISE_FROM) for row in texts}


def test_terms_and_kinds_equal_a_plain_count(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        want = plain_terms(rows)
        docs = cases.docs(spark, [(d, t, "en", "s", 1) for d, t in rows])
        got = sorted((r.doc_id, sorted((x.s, x.e, x.kind) for x in r.spans if x.kind != "email")) for r in pii.scan(docs).collect())
        assert got == sorted((d, want[d, t]) for d, t in rows)
        kinds = {k for marked in want.values() for *_, k in marked}
        assert "general" in kinds and sum(map(len, want.values())) > 30
