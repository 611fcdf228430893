"""Training sequences by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two
of n's binary form, as many of the longest (``max_length``) as fit first.
Every piece is a sequence: none crosses documents and none is padded.  Pieces
of one length form a bucket, stored as one partition of the output table, so a
loader reads batches of one shape.

Pieces are made where the texts are read; nothing is shuffled.  A sequence's
number joins the number of the task that wrote it with a counter, so numbers
are unique without a pass over all rows; the table is written once.

Defined results: a null or empty text is one piece, the end token; repeated
rows are packed like others; a null doc_id stays null; an empty table gives
no piece; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow
from ledgerline.llm.tokens import library_encoder, lower_words, slices
from ledgerline.session import scratch_path

MAX_LENGTH = 2048
_SCHEMA = "doc_id long, start long, length int, doc_tokens long, sequence_id long, offset long, ids binary"


def piece_lengths(tokens: int, max_length: int = MAX_LENGTH) -> list[int]:
    whole, rest = divmod(tokens, max_length)
    return [max_length] * whole + [1 << b for b in range(max_length.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, max_length: int = MAX_LENGTH,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset and ids (little-endian unsigned 32-bit integers)."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("the longest piece must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = library_encoder(tokenizer, lower_words), TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in slices(texts):
                ids, sizes = encoder.encode_with_end(texts[a:b], end_id)
                cut = [piece_lengths(n, max_length) for n in sizes.tolist()]
                length = np.fromiter((x for c in cut for x in c), np.int64)
                owner = np.repeat(np.arange(len(cut)), list(map(len, cut)))
                begin = np.cumsum(length) - length
                first = np.cumsum(sizes) - sizes
                n = len(length)
                raw = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(
                    (4 * np.append(begin, len(ids))).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(a, b - a).take(pa.array(owner)), pa.array(begin - first[owner]),
                    pa.array(length, pa.int32()), pa.array(sizes[owner]), pa.array(number + np.arange(n)),
                    pa.array(np.zeros(n, np.int64)), raw],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
                number += n

    return map_arrow(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                                 F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")), run, _SCHEMA)


def write_buckets(docs: DataFrame, tokenizer: str, end_id: int, folder: str, max_length: int = MAX_LENGTH,
                  text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the pieces to ``folder``, one partition per length; read back."""
    pieces(docs, tokenizer, end_id, max_length, text, doc_id).write.partitionBy("length") \
        .option("compression", "zstd").parquet(folder)
    names = ", ".join(x for x in _SCHEMA.split(", ") if not x.startswith("length")) + ", length int"
    return docs.sparkSession.read.schema(names).parquet(folder)


def packed(docs: DataFrame, tokenizer: str, end_id: int, max_length: int = MAX_LENGTH,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    folder = scratch_path(docs.sparkSession, "sequences")
    return write_buckets(docs, tokenizer, end_id, folder, max_length, text, doc_id)


def digests(packed_pieces: DataFrame) -> DataFrame:
    return packed_pieces.select("doc_id", "start", F.col("length").cast("long").alias("length"),
                                F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
