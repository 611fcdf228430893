from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.llm.components import components
from tests.llm import cases


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(values, bits):
    """Smallest value reachable over links of at most ``bits`` bits."""
    todo, out = sorted(values), {}
    for v in todo:
        if v not in out:
            stack = [v]
            out[v] = v
            while stack:
                x = stack.pop()
                for y in todo:
                    if y not in out and (x ^ y).bit_count() <= bits:
                        out[y] = v
                        stack.append(y)
    return out


def test_edge_rows_against_plain_form(spark):
    got = simhash.near_groups(cases.docs(spark)).collect()
    data = cases.rows()
    fps = [plain_fingerprint(r[1]) for r in data]
    roots, least = plain_roots(set(fps), 4), defaultdict(list)
    for r, fp in zip(data, fps):
        least[roots[fp]].append(r[0])
    want = sorted((str(r[0]), f"{fp:016x}", min(x for x in least[roots[fp]] if x is not None)) for r, fp in zip(data, fps))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_empty_table_and_extra_columns(spark):
    assert simhash.near_groups(cases.docs(spark, [])).count() == 0
    assert simhash.keep_one(cases.docs(spark, [])).count() == 0
    before = cases.docs(spark, extra=True)
    after = simhash.keep_one(before)
    assert after.columns == before.columns
    assert after.filter("doc_id = 0").count() == 1 and after.filter("doc_id = 4 OR doc_id IS NULL").count() == 0


def _clusters(seed, families, size, flips):
    rng = np.random.default_rng(seed)
    out = set(int(x) for x in rng.integers(0, 2**63, 500))
    for base in rng.integers(0, 2**63, families):
        for _ in range(size):
            x = int(base)
            for b in rng.choice(63, rng.integers(0, flips + 1), replace=False):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out)


def test_links_lose_no_pair_and_join_no_other(spark):
    for bits, block in ((4, 4096), (4, 8), (3, 16), (1, 4096), (0, 4096), (5, 32)):
        values = _clusters(bits, 8, 40, bits + 2)
        fps = spark.createDataFrame([(v,) for v in values], "fp long").repartition(4)
        got = {r.node: r.root for r in components(simhash.links(fps, bits, block)).collect()}
        want = plain_roots(values, bits)
        assert {v: got.get(v, v) for v in values} == want


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (2000, 1999), (1999, 2000)], "a long, b long")
    got = components(edges).groupBy("root").agg(F.count("*").alias("n")).collect()
    assert {r.root: r.n for r in got} == {0: 200, 1000: 299, 1999: 1}
