"""Encoders, packed files, sequences, and sentence pieces."""

import io
import itertools
import zlib

import numpy as np
import pytest

from ledgerline.llm import bitpack, packing, sentencepieces, tokens
from tests.llm import cases

TEXTS = [t or "" for t in cases.TEXTS] + ["a  b\n\n c\t\td 's they're\r\n x", "a\x1cb  c", "<|endoftext|> x<|startoftext|>y",
                                           "é é İ ΣΑΣ  　k", "x\x0b\x0c y", " lead", "trail  \n", "\xa0x \x85 y"]


def library(name):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.tokenizer_path(name))
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name,cut", [(tokens.BYTE_BPE, tokens.spaced_chunks), (tokens.WORD_BPE, tokens.words)])
def test_chunked_encoding_equals_the_library(name, cut):
    plain = library(name)
    encoder = tokens.library_encoder(tokens.tokenizer_path(name), cut)
    for _ in range(2):  # cold and warm
        ids, sizes = encoder.encode(TEXTS)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [plain(t) for t in TEXTS]
    small = tokens.Encoder(lambda c: [plain(x) for x in c], cut, tokens.RARE_SPACE, chunks=3)  # room for 3: starts over
    for t in TEXTS[:6]:
        assert small.encode([t])[0].tolist() == plain(t)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 24, 31, 32])
def test_bit_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
        raw = bitpack.pack(ids, bits)
        assert len(raw) == -(-n // 64) * 8 * bits
        assert (bitpack.unpack(raw, bits)[:n] == ids).all()
    if bits < 32:
        with pytest.raises(ValueError):
            bitpack.pack(np.array([1 << bits]), bits)
    assert bitpack.width_for(1 << bits) == bits


def test_shard_random_access():
    class Sink(io.BytesIO):
        def close(self):
            self.raw = self.getvalue()

    rng = np.random.default_rng(1)
    sizes = np.array([0, 1, 300, 64, 129, 5, 0, 1000])
    ids = rng.integers(0, 50_257, int(sizes.sum())).astype(np.uint32)
    sink = Sink()
    writer = bitpack.Writer(sink, 16, 128)
    for a, b in ((0, 3), (3, 4), (4, 8)):
        first, last = int(sizes[:a].sum()), int(sizes[:b].sum())
        writer.add([None if a == 0 and i == 1 else 10 + i for i in range(a, b)], ids[first:last], sizes[a:b])
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    shard = bitpack.Reader(Source(sink.raw))
    assert shard.doc_ids.to_pylist() == [10, None, 12, 13, 14, 15, 16, 17]
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    assert all((shard.document(i) == p).all() for i, p in enumerate(parts))
    assert (shard.ids(250, 900) == ids[250:1150]).all()
    with pytest.raises(ValueError):
        bitpack.Reader(Source(sink.raw[:-3] + b"xyz"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packed_ids_of_edge_rows(spark):
    plain = library(tokens.BYTE_BPE)
    data = cases.rows()
    got = bitpack.packed_ids(cases.docs(spark), tokens.tokenizer_path(tokens.BYTE_BPE), tokens.BYTE_BPE_IDS, 2).collect()
    ids = [(r[0], plain(r[1] or "") + [2]) for r in data]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(x), crc(x)) for d, x in ids)
    rows = sorted(got, key=lambda r: r.start)  # gapless, in ascending order of doc_id, null first
    assert [r.start for r in rows] == [0, *itertools.accumulate(r.n_tokens for r in rows)][:-1]
    assert [r.doc_id for r in rows] == sorted((r[0] for r in data), key=lambda x: (x is not None, x or 0))
    assert bitpack.packed_ids(cases.docs(spark, []), tokens.tokenizer_path(tokens.BYTE_BPE), tokens.BYTE_BPE_IDS, 2).count() == 0


def test_sequences_of_edge_rows(spark):
    plain = library(tokens.WORD_BPE)
    data = cases.rows()
    for longest in (2048, 16):
        table = packing.packed(cases.docs(spark, extra=True), tokens.tokenizer_path(tokens.WORD_BPE), 1, longest)
        got = packing.digests(table).collect()
        ids = table.collect()
        assert len({r.sequence_id for r in got}) == len(got) and all(r.offset == 0 for r in got)
        assert all(r.length & (r.length - 1) == 0 and r.length <= longest for r in got)
        assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(bytes(r.ids)) for r in ids)
        want = []
        for r in data:
            x, at = plain(r[1] or "") + [1], 0
            for n in packing.piece_lengths(len(x), longest):
                want.append((str(r[0]), at, n, crc(x[at:at + n]), len(x)))
                at += n
            assert at == len(x)
        assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(want)
    assert packing.packed(cases.docs(spark, []), tokens.tokenizer_path(tokens.WORD_BPE), 1).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(cases.docs(spark), tokens.tokenizer_path(tokens.WORD_BPE), 1, 100)


def toy():
    pieces = ["<unk>"] + [f"<0x{b:02X}>" for b in range(256)] + ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁▁", "é", "▁aé"]
    scores = [0.0] * 257 + [-2.0, -3.0, -2.5, -2.6, -4.0, -4.2, -5.0, -3.1, -6.0, -8.5]
    return sentencepieces.Vocabulary(pieces, scores, ["control"] + ["byte"] * 256 + ["piece"] * 10)


def test_viterbi_is_the_best_of_all_segmentations():
    v = toy()
    model, known = sentencepieces.Model(v), dict(zip(v.pieces[257:], v.scores[257:]))
    unknown = min(known.values()) - sentencepieces.UNKNOWN_PENALTY

    def best(s):
        if not s:
            return 0.0
        ways = [known[s[:n]] + best(s[n:]) for n in range(1, len(s) + 1) if s[:n] in known]
        return max(ways + ([unknown + best(s[1:])] if s[0] not in known else []))

    def total(ids):
        out, run = 0.0, b""
        for i in ids:
            if v.kinds[i] == "byte":
                run += bytes([i - 1])
                if len(run.decode("utf-8", "ignore")) == 1:
                    out, run = out + unknown, b""
            else:
                out += v.scores[i]
        return out

    for n in range(1, 7):
        for s in map("".join, itertools.product("▁abéx", repeat=n)):
            assert abs(total(model.segment(s.encode())) - best(s)) < 1e-9


def test_pieces_round_trip(spark):
    model = sentencepieces.Model(sentencepieces.read_vocabulary(tokens.tokenizer_path(sentencepieces.PIECES_FILE)))
    hard = ["▁x▁ y\x00z", "\x000\x001", " ", "   ", "á \U0001F600\n\t", "▁"]
    data = cases.rows() + [(300 + i, t, "en", "s", 1) for i, t in enumerate(hard)]
    got = sentencepieces.decode(sentencepieces.encode(cases.docs(spark, data), model), model).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(r[0]), r[1] or "") for r in data)
    assert sentencepieces.decode(sentencepieces.encode(cases.docs(spark, []), model), model).count() == 0
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=tokens.tokenizer_path(sentencepieces.PIECES_FILE))
    for t in (cases.PROSE, "über ☃ x", "a  b"):
        ids = model.encoder().encode([t])[0].tolist()
        assert own.decode(ids) == model.decode(ids) == t


HARD_CHUNKS = ["the", "The", "don't", "it's", "word.", "word,.", "...", "été", "İstanbul", "ǅ", "naïve!", "x²", "a1b", "一二", "ﬁne", "é",
               "<|endoftext|>", "'s", "s'", "A", "co-op", "straße", "Straße.", "ΟΔΥΣΣΕΥΣ", "😀", "ok?", "?", "ª", "á"]


@pytest.mark.parametrize("name,cut,form", [(tokens.BYTE_BPE, tokens.spaced_chunks, " {}"), (tokens.BYTE_BPE, tokens.spaced_chunks, "{}"),
                                           (tokens.WORD_BPE, tokens.lower_words, "{}"), (tokens.WORD_BPE, tokens.words, "{}")])
def test_joined_chunks_have_the_ids_of_single_ones(name, cut, form):
    encoder = tokens.library_encoder(tokens.tokenizer_path(name), cut)
    chunks = [form.format(c) for c in HARD_CHUNKS * 30 + [f"w{i}" for i in range(300)]] + ["\n", "  ", "\n\n "]
    flat, begin, sizes = encoder._joined(chunks)
    assert [flat[b:b + n].tolist() for b, n in zip(begin.tolist(), sizes.tolist())] == [encoder._ids([c])[0] for c in chunks]
    assert sum(map(encoder._joined._count, chunks)) > 300 or "{}" == form and name == tokens.BYTE_BPE


def test_texts_of_words_that_lose_case():
    encoder = tokens.library_encoder(tokens.tokenizer_path(tokens.WORD_BPE), tokens.lower_words)
    texts = [" ".join(HARD_CHUNKS), "Plain Words. In ASCII, only!", "MIXED Été ß"] * 2
    ids, sizes = encoder.encode(texts)
    want = [encoder._ids([t])[0] for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
