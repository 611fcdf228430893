import random
from collections import defaultdict
from itertools import permutations

import numpy as np

from ledgerline.llm import filter_audit
from tests.llm import cases
from tests.llm.test_word_runs import plain_words


def test_survival_words_and_popcounts():
    words = filter_audit.survival_words(5)
    for mask in range(32):
        assert [words[mask] >> s & 1 for s in range(32)] == [int(not mask & s) for s in range(32)]
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 100, 4097):
        some = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert filter_audit.positional_popcounts(some).tolist() == [int((some >> np.uint32(b) & np.uint32(1)).sum()) for b in range(32)]


def plain_audit(docs, labels):
    """Walk every document through every order."""
    first, marks = {}, defaultdict(lambda: [False, False])
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    for d, quality, toxic in labels:
        if d is not None:
            marks[d] = [marks[d][0] or quality == 1, marks[d][1] or toxic == 1]
    fails, out, shapley = [], defaultdict(lambda: [0] * 6), defaultdict(int)
    for d, t, part in docs:
        t = t or ""
        words = plain_words(t)
        copy = t in first and (d is None or d > first[t])
        fails.append("".join(f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            any(c in "#$%&*|" for c in t), copy)) if bad))
    for order in permutations("ABCDE"):
        name = "".join(order)
        for (d, _, part), bad in zip(docs, fails):
            gone, part = False, part or ""
            good, toxic = marks[d] if d is not None else (False, False)
            for step, f in enumerate(order, 1):
                row = out[part, name, step]
                here = f in bad and not gone
                row[1] += here
                row[2] += f in bad and gone
                row[3] += bad == f
                row[4] += here and good
                row[5] += here and toxic
                gone = gone or here
                row[0] += not gone
                shapley[part, f] += here
    return sorted((*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items())


def test_audit_against_every_order(spark):
    rng = random.Random(5)
    texts = [None, "", "Short Text", "word " * 250, " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(300)),
             "a # b", " ".join(f"é{i}" for i in range(260)) + " 100%"] + cases.TEXTS[:6]
    docs = [(rng.choice([None, rng.randrange(60)]) if i % 9 == 0 else i, rng.choice(texts), rng.choice(["x", "y", "", None])) for i in range(120)]
    labels = [(rng.randrange(120), rng.randrange(2), rng.randrange(2)) for _ in range(90)] + [(None, 1, 1), (5, None, 1), (5, 1, None)]
    df = spark.createDataFrame([(d, t, p, "clash") for d, t, p in docs], "doc_id long, text string, source string, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.filter_audit(df.repartition(3), marks).collect())
    assert got == plain_audit(docs, labels)


def test_empty_tables(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(cases.docs(spark, []), marks).count() == 0
    got = filter_audit.filter_audit(cases.docs(spark), marks)
    assert got.count() == 600 * 2  # sources "s" and, where null, ""
    assert got.agg({"good_lost": "sum", "toxic_lost": "sum"}).first()[:] == (0, 0)


def test_fewer_filters(spark):
    flagged = spark.createDataFrame([("p", m, False, False) for m in (0, 1, 2, 3, 3)], "part string, mask int, good boolean, toxic boolean")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley)
           for r in filter_audit.audit(flagged, "XY").collect()}
    assert got == {("XY", 1): (2, 3, 0, 1, 4), ("XY", 2): (1, 1, 2, 1, 4), ("YX", 1): (2, 3, 0, 1, 4), ("YX", 2): (1, 1, 2, 1, 4)}
