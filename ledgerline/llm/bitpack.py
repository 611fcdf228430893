"""Token ids in fixed-width packed files.

Each id takes the fewest bits that hold the vocabulary.  64 ids of b bits fill
exactly b 64-bit words, so packing and unpacking are 64 vectorised shifts over
all groups at once, and the place of any id is known from its number.

File layout (little-endian):
  head     "PACKIDS1", bits u32, ids per block u32 (a multiple of 64)
  blocks   each ``bits * ids_per_block / 8`` bytes; the last is zero-filled
  index    block offsets u64[blocks + 1], document ids i64[docs],
           document id present u8[docs], end of each document u64[docs]
  tail     ids u64, documents u64, blocks u64, place of the index u64, "PACKIDS1"

A data set is a folder of such shards in ascending doc_id order (null first)
plus a manifest table.  A shard is written under a name of its own attempt and
then renamed, so a task that runs twice leaves one whole file with the same
content.  A shard is written and read in pieces, never held whole.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, stored
from ledgerline.llm.tokens import library_encoder, slices, spaced_chunks
from ledgerline.session import scratch_path

MAGIC = b"PACKIDS1"
BLOCK_IDS = 4096
_HEAD, _TAIL = struct.Struct("<8sII"), struct.Struct("<QQQQ8s")
_AT_ONCE = 1 << 20  # ids read at once


def width_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids (zero-filled to a multiple of 64) as packed bytes."""
    groups = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    groups.reshape(-1)[:len(ids)] = ids
    if len(ids) and int(groups.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    words = np.zeros((len(groups), bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= groups[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= groups[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(raw: bytes, bits: int) -> np.ndarray:
    words = np.frombuffer(raw, "<u8").reshape(-1, bits)
    ids, mask = np.empty((len(words), 64), np.uint32), np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, j] = value & mask
    return ids.reshape(-1)


class Writer:
    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS) -> None:
        if block_ids % 64:
            raise ValueError("a block holds a multiple of 64 ids")
        self._out, self._bits, self._block = out, bits, block_ids
        self._left = np.zeros(0, np.uint32)
        self._docs: list[np.ndarray] = []
        self._sizes: list[np.ndarray] = []
        self.ids = self.docs = self._blocks = 0
        out.write(_HEAD.pack(MAGIC, bits, block_ids))

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        known = np.array([(d or 0, d is not None) for d in doc_ids], "i8,u1")
        self._docs.append(known)
        self._sizes.append(sizes)
        self.ids, self.docs = self.ids + len(ids), self.docs + len(sizes)
        ids = np.concatenate([self._left, ids])
        whole = len(ids) // self._block * self._block
        self._write(ids[:whole])
        self._left = ids[whole:].copy()

    def _write(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), 64 * self._block):
            part = ids[at:at + 64 * self._block]
            short = -len(part) % self._block
            self._out.write(pack(np.concatenate([part, np.zeros(short, part.dtype)]) if short else part, self._bits))
            self._blocks += (len(part) + short) // self._block

    def close(self) -> None:
        if len(self._left):
            self._write(self._left)
        size = self._bits * self._block // 8
        docs = np.concatenate(self._docs) if self._docs else np.zeros(0, "i8,u1")
        ends = np.cumsum(np.concatenate(self._sizes)) if self._sizes else np.zeros(0)
        self._out.write((_HEAD.size + size * np.arange(self._blocks + 1)).astype("<u8").tobytes())
        self._out.write(docs["f0"].astype("<i8").tobytes() + docs["f1"].tobytes() + ends.astype("<u8").tobytes())
        self._out.write(_TAIL.pack(self.ids, self.docs, self._blocks, _HEAD.size + size * self._blocks, MAGIC))
        self._out.close()


class Reader:
    """Random access to a shard: ``ids(first, count)``, ``document(i)``."""

    def __init__(self, file) -> None:
        self._file = file
        head, bits, self._block = _HEAD.unpack(self._at(0, _HEAD.size))
        self.n_ids, self.n_docs, blocks, index, tail = _TAIL.unpack(self._at(file.size() - _TAIL.size, _TAIL.size))
        if head != MAGIC or tail != MAGIC:
            raise ValueError("not a whole file of packed ids")
        self._bits, n = bits, self.n_docs
        raw = self._at(index, 8 * (blocks + 1) + 17 * n)
        self._offsets = np.frombuffer(raw, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        ids, present = np.frombuffer(raw, "<i8", n, at), np.frombuffer(raw, "u1", n, at + 8 * n)
        self.doc_ids = pa.array(ids, mask=present == 0)
        self.ends = np.frombuffer(raw, "<u8", n, at + 9 * n).astype(np.int64)

    def _at(self, place: int, size: int) -> bytes:
        self._file.seek(place)
        return self._file.read(size)

    def ids(self, first: int, count: int) -> np.ndarray:
        if not count:
            return np.zeros(0, np.uint32)
        a, b = first // self._block, (first + count - 1) // self._block + 1
        raw = self._at(int(self._offsets[a]), int(self._offsets[b] - self._offsets[a]))
        return unpack(raw, self._bits)[first - a * self._block:][:count]

    def document(self, i: int) -> np.ndarray:
        start = int(self.ends[i - 1]) if i else 0
        return self.ids(start, int(self.ends[i]) - start)


def write_ids(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, folder: str,
              text: str = "text", doc_id: str = "doc_id", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of all documents to ``folder``, a shared place that
    pyarrow.fs can open; returns the manifest: shard, path, n_docs, n_ids and
    start, the number of ids in the shards before."""
    bits = width_for(vocabulary)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    tie = F.xxhash64(t)  # a null id on many rows still spreads
    ordered = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), t.alias("text"), tie.alias("tie")) \
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer = TaskContext.get().partitionId(), None
        store, place = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = library_encoder(tokenizer, spaced_chunks)
                store.create_dir(place, recursive=True)
                name, draft = f"{place}/shard-{shard:07d}.ids", f"{place}/draft-{uuid.uuid4().hex}"
                writer = Writer(store.open_output_stream(draft), bits, block_ids)
            keys, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for a, b in slices(texts):
                writer.add(keys[a:b], *encoder.encode_with_end(texts[a:b], end_id))
        if writer is not None:
            writer.close()
            store.move(draft, name)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name.rpartition('/')[2]}"],
                "n_docs": [writer.docs], "n_ids": [writer.ids]})

    manifest = stored(map_arrow(ordered, run, "shard int, path string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """The files' documents: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["start"].to_pylist()):
                store, place = pafs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    yield from documents(Reader(file), base)

    def documents(shard: Reader, base: int) -> Iterator[pa.RecordBatch]:
        starts = np.concatenate([[0], shard.ends[:-1]]) if shard.n_docs else shard.ends
        a = 0
        while a < shard.n_docs:
            b = max(a + 1, int(np.searchsorted(shard.ends, starts[a] + _AT_ONCE, "right")))
            ids = memoryview(shard.ids(int(starts[a]), int(shard.ends[b - 1] - starts[a])).astype("<u4").tobytes())
            cut = 4 * (np.append(starts[a:b], shard.ends[b - 1]) - starts[a])
            crc = [zlib.crc32(ids[x:y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [shard.doc_ids[a:b], pa.array(base + starts[a:b]), pa.array(shard.ends[a:b] - starts[a:b]),
                 pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
            a = b

    tasks = max(1, manifest.count())
    return map_arrow(
        manifest.select("path", "start").repartition(tasks), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed_ids(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """Encode, write and read back in the shared checkpoint folder."""
    folder = scratch_path(docs.sparkSession, "packed-ids")
    return read_documents(write_ids(docs, tokenizer, vocabulary, end_id, folder))
