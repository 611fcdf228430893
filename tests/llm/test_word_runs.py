import hashlib
import random
import re
import zlib

from ledgerline.llm import queries, word_runs
from tests.llm import cases


def plain_runs(words, least=12):
    """Every period by itself; of equal stretches the smallest period counts."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                out.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_words(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def sequences(seed, count):
    rng = random.Random(seed)
    for i in range(count):
        n, letters = rng.randrange(160), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(n)]
        if i % 5 == 1:  # one long period with a few words changed
            words = words[:rng.randrange(1, 20)] * 9
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words) or 1):][:1] = [9]
        elif i % 5 == 2:  # equal runs apart, which touch or nearly touch
            words = [1] * rng.randrange(60) + [2] * rng.randrange(2) + [1] * rng.randrange(60) + words[:9]
        elif i % 5 == 3:  # runs of runs
            for _ in range(3):
                words = words[:8] * rng.randrange(1, 4) + words[:rng.randrange(9)]
        elif i % 5 == 4:
            a, b = [0], [0, 1]
            for _ in range(rng.randrange(9)):
                a, b = b, b + a
            words = b[rng.randrange(len(b)):] + b[:rng.randrange(60)]
        yield words


def test_runs_against_every_period(spark):
    for words in sequences(1, 1500):
        for least in (1, 12):
            assert word_runs.find_runs(words, least) == plain_runs(words, least)


def test_wrong_fingerprints_change_nothing():
    for words in sequences(2, 600):
        for modulus in (3, 7, 101):
            assert word_runs.find_runs(words, 1, modulus) == plain_runs(words, 1)


def test_long_texts_grow_about_linearly():
    import time
    took = []
    for n in (20_000, 160_000):
        for words in (["a"] * n, ["a"] * (n // 2) + ["x"] + ["a"] * (n // 2)):
            start = time.perf_counter()
            found = word_runs.find_runs(words)
            took.append(time.perf_counter() - start)
            assert [r[2] for r in found] == [1] * len(found) and len(found) <= 2
    assert took[2] + took[3] < 8 * 4 * (took[0] + took[1]) + 1


def plain_row(doc_id, text):
    words = plain_words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    def digest(t):
        return hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_on_edge_rows(spark, tmp):
    data = [(i, t) for i, t in enumerate(cases.TEXTS) if t is None or len(t) < 5000]
    data += [(i, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2) for i in range(100, 160)]
    data += [(None, "x y " * 20), (3, "x y " * 20), (3, "x y " * 20), (None, None)]
    rows = [(d, t, None, "s", 0) for d, t in data]
    path = cases.written(spark, tmp, rows)
    got = [tuple(r) for r in queries.op11_word_runs(spark, path).collect()]
    assert sorted(map(str, got)) == sorted(str(plain_row(d, t)) for d, t in data)
    assert sum(r[1] > 0 for r in got) > 4


def test_empty_table_and_clashing_columns(spark):
    assert word_runs.word_runs(cases.docs(spark, [])).count() == 0
    got = word_runs.word_runs(cases.docs(spark, extra=True).withColumnRenamed("lang", "runs").withColumnRenamed("source", "collapsed"))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and got.count() == len(cases.rows())
    assert got.filter("doc_id = 13").first().collapsed.split() == ["same", "line", "here"]
