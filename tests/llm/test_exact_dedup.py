import hashlib
import re
from collections import defaultdict

from ledgerline.llm import exact_dedup
from tests.llm import cases


def plain(rows):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    for r, t in zip(rows, norm):
        groups[t].append(r[0])
    first = {t: min((x is None, x or 0) for x in ids) for t, ids in groups.items()}
    return sorted((str(r[0]), str(None if first[t][0] else first[t][1]), len(groups[t]),
                   hashlib.sha256(t.encode()).hexdigest()) for r, t in zip(rows, norm))


def result(df):
    rows = df.collect()
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows), rows


def test_edge_rows_at_several_block_sizes(spark):
    data = cases.rows()
    for width in (7, 64, 4096):
        got, rows = result(exact_dedup.exact_groups(cases.docs(spark), block_bytes=width))
        assert got == plain(data)
        assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})


def test_fingerprints_that_collide_are_replaced(spark):
    data = [(i, f"text number {i % 40} " + "x" * (i % 5), "en", "s", 1) for i in range(200)]
    got, _ = result(exact_dedup.exact_groups(cases.docs(spark, data), block_bytes=4, fingerprint_bits=2))
    assert got == plain(data)


def test_keep_first_keeps_columns_and_one_row_per_text(spark):
    before = cases.docs(spark, extra=True)
    after = exact_dedup.keep_first(before)
    assert after.columns == before.columns
    texts = [re.sub(r"\s+", " ", r.text or "") for r in after.collect()]
    assert len(texts) == len(set(texts)) == len({p[3] for p in plain(cases.rows())})
    assert exact_dedup.keep_first(cases.docs(spark, [])).count() == 0
    assert exact_dedup.exact_groups(cases.docs(spark, [])).count() == 0
