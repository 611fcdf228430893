import random
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import jaccard_join
from tests.conftest import SF001
from tests.llm import cases
from tests.llm.test_word_runs import plain_words


def plain_sets(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = plain_words(lower)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_groups(rows, percent=80):
    """Counts of shared shingles for every two rows that share one."""
    sets, parent, holders = [plain_sets(t) for _, t in rows], list(range(len(rows))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        for j, shared in Counter(j for g in own for j in holders[g]).items():
            if 100 * shared >= percent * (len(own) + len(sets[j]) - shared):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for g in own:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min([x for x in (least.get(root(i)), d) if x is not None], default=None)
    return sorted(((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def test_edge_rows(spark):
    got = sorted((tuple(r) for r in jaccard_join.near_groups(cases.docs(spark)).collect()), key=str)
    assert got == plain_groups([r[:2] for r in cases.rows()])


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in jaccard_join.near_groups(docs).collect()), key=str)
    assert got == plain_groups([tuple(r) for r in docs.collect()])


def mixed_rows(seed=3):
    """A large family of near copies, a passage in many texts, prefixes of one
    text (their sizes differ), short texts and words of two letters."""
    rng = random.Random(seed)
    base = [rng.choice("abcdefghijklm") + str(rng.randrange(40)) for _ in range(200)]
    passage, rows = [f"p{i}" for i in range(30)], []
    for i in range(500):
        words = [list(base), [f"u{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60))] + passage, base[:rng.randrange(1, 60)],
                 passage[:rng.randrange(30)] + [f"z{rng.randrange(3)}" for _ in range(rng.randrange(4))],
                 [rng.choice("xy") for _ in range(rng.randrange(14))]][i % 5]
        if i % 5 == 0:
            for _ in range(rng.randrange(9)):
                words[rng.randrange(200)] = f"e{rng.randrange(5)}"
        rows.append((rng.randrange(10**6), rng.choice([" ", "\n\t"]).join(words) if words else rng.choice([None, "", " "])))
    return rows


@pytest.mark.parametrize("options", [{}, {"frequent": 2, "block": 4}, {"frequent": 4, "most": 8, "block": 16},
                                     {"percent": 60, "frequent": 3, "block": 8}, {"percent": 100}])
def test_no_link_is_lost(spark, options):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((tuple(r) for r in jaccard_join.near_groups(df, **options).collect()), key=str)
    assert got == plain_groups(rows, options.get("percent", 80))


def families(n=40):
    """Of sets of single words: two that agree in their prefix and size alone,
    and a third that links with one of them by another prefix."""
    rows = []
    for f in range(n):
        words = sorted((f"f{f}w{i}" for i in range(60)), key=lambda w: int(jaccard_join.shingle_set(w.encode(), 1)[0]))
        first, second, third = words[:5] + words[10:25], words[:5] + words[30:45], words[1:6] + words[30:45]
        rows += [(3 * f + i, " ".join(own)) for i, own in enumerate((first, second, third))]
    return rows


def test_members_of_a_group_in_a_short_list(spark):
    rows = families()
    got = sorted(tuple(r) for r in jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), 1).collect())
    assert got == [(d, 20, d - 1 if d % 3 == 2 else d) for d, _ in rows]


def test_empty_table_and_clashing_columns(spark):
    assert jaccard_join.near_groups(cases.docs(spark, [])).count() == 0
    df = cases.docs(spark, extra=True).withColumnRenamed("lang", "raw").withColumnRenamed("source", "n")
    assert jaccard_join.near_groups(df).columns == ["doc_id", "n_shingles", "component_id"]
    assert jaccard_join.near_groups(df).count() == len(cases.rows())
