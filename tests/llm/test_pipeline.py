import hashlib
import re
import zlib

import numpy as np

import corpus_pipeline
from ledgerline.llm import packing, quality, tokens
from ledgerline.llm.common import documents, stored
from tests.llm import cases
from tests.llm.test_simhash import plain_fingerprint, plain_roots
from tests.llm.test_spans import SECRETS, plain
from tests.llm.test_tokens import library


def _data():
    base = cases.PROSE * 3
    extra = [base + f" and then number {i} password=abcdef{i} came by." for i in range(6)]
    return cases.rows() + [(400 + i, t, "en", "s", len(t)) for i, t in enumerate(extra + extra[:2] + [extra[0].replace("boats", "ships")])]


def test_stages_against_plain_forms(spark, tmp):
    folder = cases.written(spark, tmp, _data())
    docs, first = documents(spark, folder), corpus_pipeline.STAGES
    assert [n for n, _ in first] == ["quality rules", "exact dedup", "simhash near-dedup", "secret scan", "packing"]
    columns = docs.columns
    verdict = sorted(r.row.doc_id or -1 for r in quality.assess(docs).filter("kept").collect())
    good = stored(first[0][1](spark, docs, folder), "t")
    assert sorted(r.doc_id or -1 for r in good.collect()) == verdict and good.columns == columns

    seen, texts = {}, [(r.doc_id, r.text) for r in good.collect()]
    for i, t in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        seen.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).digest(), i)
    once = stored(first[1][1](spark, good, folder), "t")
    assert sorted(r.doc_id for r in once.collect()) == sorted(seen.values()) and once.columns == columns

    rows = once.collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    roots = plain_roots(set(fps.values()), 4)
    heads = {}
    for i in sorted(fps):
        heads.setdefault(roots[fps[i]], i)
    apart = stored(first[2][1](spark, once, folder), "t")
    assert sorted(r.doc_id for r in apart.collect()) == sorted(heads.values()) and apart.columns == columns

    was = {r.doc_id: r.text for r in apart.collect()}
    clean = stored(first[3][1](spark, apart, folder), "t")
    assert clean.columns == columns and clean.count() == len(was)
    for r in clean.collect():
        assert not plain(r.text, SECRETS) and r.n_chars == len(r.text)
        assert r.text == was[r.doc_id] or plain(was[r.doc_id], SECRETS)

    ids = library(tokens.WORD_BPE)
    want = []
    for r in clean.collect():
        x, at = ids(r.text) + [1], 0
        for n in packing.piece_lengths(len(x)):
            want.append((r.doc_id, at, n, zlib.crc32(np.array(x[at:at + n], "<u4").tobytes())))
            at += n
    got = first[4][1](spark, clean, folder).collect()
    assert sorted((r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in got) == sorted(want)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.start, r.length) for r in whole.collect()) == sorted(w[:3] for w in want)


def test_empty_documents_and_extra_columns(spark, tmp):
    assert corpus_pipeline.run(spark, cases.written(spark, tmp + "/a", [])).count() == 0
    docs = documents(spark, cases.written(spark, tmp + "/b", None, True))
    for _, stage in corpus_pipeline.STAGES[:4]:
        columns = docs.columns
        docs = stored(stage(spark, docs, tmp), "t")
        assert docs.columns == columns
