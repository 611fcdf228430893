"""SentencePiece-style encoding and decoding.

Encoding finds the segmentation of a text with the best total score (unigram
Viterbi).  Pieces are found by walking a double-array trie over their UTF-8
bytes.  A character that no piece covers falls back to one piece per byte.
White space is kept as a marker: a space becomes U+2581, and one is put before
a text.  Decoding reverses that exactly: ``decode(encode(text)) == text`` for
every text, because a U+2581 that a text has itself is encoded by bytes.

The trie is built once on the driver and sent with the task: its size is that
of the vocabulary.  Segments between spaces are solved apart, which is exact
since no piece goes on past a space after a letter (checked when the model is
read); repeated ones are looked up.

Scores: a model of the unigram kind brings its log probabilities.  In one
of the BPE kind, which is what the public file is, a score only tells the rank
of a piece; its log score then is ``-log(rank + 2)``, Zipf's law without its
constant.

Defined results: null and empty texts have no pieces; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow
from ledgerline.llm.tokens import Encoder, slices

PIECES_FILE = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0  # an uncovered character scores this much below the worst piece
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_OWN_MARK = "\x00"  # stands for a U+2581 of the text's own while segments are cut; not in any piece


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[str]  # "piece", "byte" or "control"


def zipf_scores(ranks: Sequence[float]) -> list[float]:
    return [-math.log(abs(r) + 2) for r in ranks]


def read_vocabulary(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = range(model.get_piece_size())
    kinds = ["byte" if model.is_byte(i) else
             "control" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece" for i in n]
    raw = [model.get_score(i) for i in n]
    ranked = all(float(r).is_integer() for r in raw)
    return Vocabulary([model.id_to_piece(i) for i in n], zipf_scores(raw) if ranked else raw, kinds)


def double_array(keys: list[tuple[bytes, int]]) -> tuple[list[int], list[int], list[int]]:
    """base, check and value: node n has the child n' = base[n] + byte + 1
    when check[n'] = n; value is the key's number, -1 for none."""
    keys = sorted(keys)
    size = 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    dense, todo = 1, [(0, 0, len(keys), 0)]  # node, its range of keys, depth
    while todo:
        node, a, b, depth = todo.pop()
        if a < b and len(keys[a][0]) == depth:
            value[node] = keys[a][1]
            a += 1
        if a == b:
            continue
        starts, labels = [], []
        for i in range(a, b):
            c = keys[i][0][depth] + 1
            if not labels or labels[-1] != c:
                labels.append(c)
                starts.append(i)
        starts.append(b)
        # the first label's place: from where slots are no longer almost all taken
        place, taken = max(labels[0], dense), 0
        looked = place
        while True:
            while place + 257 > len(check):
                base += [0] * len(base)
                check += [-1] * len(check)
                value += [-1] * len(value)
            if check[place] >= 0:
                taken += 1
            elif all(check[place - labels[0] + c] < 0 for c in labels):
                break
            place += 1
        if taken >= 0.95 * (place - looked + 1):
            dense = place
        at = place - labels[0]
        base[node] = at
        for k, c in enumerate(labels):
            check[at + c] = node
            todo.append((at + c, starts[k], starts[k + 1], depth + 1))
    return base + [0] * 257, check + [-1] * 257, value + [-1] * 257


class Model:
    def __init__(self, vocabulary: Vocabulary) -> None:
        v = vocabulary
        keys = [(p.encode(), i) for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == "piece"]
        inside = re.compile(f"[^{MARK}]{MARK}")
        if any(inside.search(v.pieces[i]) for _, i in keys):
            raise ValueError("a piece goes on past a space: segments can't be solved apart")
        self._base, self._check, self._value = double_array(keys)
        self._score = v.scores
        self._unknown = min(v.scores[i] for _, i in keys) - UNKNOWN_PENALTY
        byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == "byte"}
        if len(byte) != 256:
            raise ValueError("the model has no byte pieces to fall back to")
        self._byte = [byte[b] for b in range(256)]
        self.is_byte = np.array([k == "byte" for k in v.kinds])
        self._raw = [bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "control" else
                     p.replace(MARK, " ").encode() for p, k in zip(v.pieces, v.kinds)]

    def segment(self, raw: bytes) -> list[int]:
        """The best segmentation of one segment, in piece ids.  Of equal ones
        the one whose last piece is longest is taken, from the end on."""
        base, check, value, score = self._base, self._check, self._value, self._score
        n, low = len(raw), -math.inf
        best, start, piece = [low] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0], i = 0.0, 0
        while i < n:
            lead = raw[i]
            step = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, node, j = best[i], 0, i
            single = False
            while j < n:
                to = base[node] + raw[j] + 1
                if check[to] != node:
                    break
                node, j = to, j + 1
                key = value[node]
                if key >= 0:
                    single = single or j == i + step
                    if here + score[key] > best[j]:
                        best[j], start[j], piece[j] = here + score[key], i, key
            if not single and here + self._unknown > best[i + step]:
                best[i + step], start[i + step], piece[i + step] = here + self._unknown, i, -1
            i += step
        out, j = [], n
        while j:
            i = start[j]
            if piece[j] >= 0:
                out.append(piece[j])
            else:
                out.extend(self._byte[b] for b in reversed(raw[i:j]))
            j = i
        return out[::-1]

    def segments(self, parts: list[str]) -> list[list[int]]:
        own = [b for b in MARK.encode()]
        out = []
        for part in parts:
            if _OWN_MARK in part:  # a U+2581 of the text's own, or U+0000: by bytes
                ids: list[int] = []
                for k, bit in enumerate(re.split("(\x00[01])", part)):
                    ids += [self._byte[b] for b in (own if bit == "\x001" else [0])] if k % 2 else \
                        self.segment(bit.encode())
                out.append(ids)
            else:
                out.append(self.segment(part.encode()))
        return out

    def encoder(self) -> Encoder:
        return Encoder(self.segments, cut)

    def decode(self, ids: Sequence[int]) -> str:
        raw = self._raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def cut(text: str) -> list[str]:
    """Segments of a text with its white space marked."""
    if not text:
        return []
    if MARK in text or _OWN_MARK in text:
        text = text.replace("\x00", "\x000").replace(MARK, "\x001")
    return _SEGMENT.findall(MARK + text.replace(" ", MARK))


_SCHEMA = "doc_id long, ids array<int>"


def encode(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model.encoder()
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in slices(texts):
                ids, sizes = encoder.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                                 pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), lists], ["doc_id", "ids"])

    return map_arrow(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                                 F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")), run, _SCHEMA)


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id, ids -> doc_id, text, and of the ids n_pieces, n_bytes (pieces
    of byte fallback) and ids_crc32 (as little-endian unsigned 32 bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["ids"].flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(batch["ids"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
            parts = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([model.decode(p.tolist()) for p in parts], pa.string()),
                pa.array([len(p) for p in parts], pa.int64()),
                pa.array([int(model.is_byte[p].sum()) for p in parts], pa.int64()),
                pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())],
                ["doc_id", "text", "n_pieces", "n_bytes", "ids_crc32"])

    return map_arrow(encoded, run, "doc_id long, text string, n_pieces long, n_bytes long, ids_crc32 long")
