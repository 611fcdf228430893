"""File-layout maintenance for Parquet tables: build a fragmented layout,
compact, Z-order, describe, and skip files with a min/max manifest.

Open Spark has no OPTIMIZE/ZORDER for Parquet, so these are rewrites planned
with ordinary DataFrame operators:

* ``fragment``: every file holds a hash shard of the key, so every file spans
  every date (the worst case for a date-range scan).
* ``compact``: ``n = ceil(bytes / target)`` files, range-partitioned on the
  clustering columns, where there are any, and sorted inside each file.
* ``zorder``: the same, on an interleaved (Morton) key, so each file's
  min/max box is small in *every* clustering column.
* ``write_manifest``: one distributed aggregate of per-file row counts and
  min/max of the clustering columns, stored next to the table;
  ``skipping_scan`` then opens only the files whose range overlaps the
  predicate (file-level skipping; row-group skipping inside the kept files
  still comes from Parquet's pushed filters).

Evidence, each computed from the files apart from the operator that it judges:

* ``detail`` and ``boxes``: rows, bytes and min/max of each file, from footers;
* ``compaction_holds``: as many files as asked, none far above the target size,
  none far below an even share of the rows;
* ``in_key_order``: no file's largest key is above the next one's smallest;
* ``boxes_hold``: the min/max that readers skip by are those of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from ledgerline.functions.zorder import CELL_BITS, zorder_key
from ledgerline.operators.footers import footers
from ledgerline.session import checkpoint_root

DEFAULT_TARGET_BYTES = 128 * 1024 * 1024
LISTED_FILES = 10_000
LISTED_VALUES = 1 << 16
# A row of the shuffle of a rewrite holds at most so many rows of one stretch, taken
# from as many as a task holds at once.  A stretch is so many places in key order.
CHUNK_ROWS = 4096
HELD_ROWS = 1 << 20
HELD_BYTES = 128 * 1024 * 1024
STRETCH_BITS = 18


def crc32_shard(key: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(n)).cast("int")


def fragment(df: DataFrame, key: str, n: int, path: str, shard: Column | None = None) -> None:
    """Write ``df`` as ``n`` hash shards of ``key`` (``pmod(crc32(key), n)``
    unless ``shard`` gives another number below ``n``) in one job: shard i is
    partition i, so each shard is one file."""
    number = crc32_shard(key, n) if shard is None else shard.cast("int")
    (df.withColumn("_shard", number).repartitionById(n, "_shard").drop("_shard")
     .write.mode("overwrite").parquet(path))


def _row_hash(df: DataFrame):
    """Tie-break key from the row's physical identity in the Parquet table
    being rewritten (file path + row index): unique even for identical rows
    and the same on every recomputation."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def _slim(rows: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """Columns ``by`` and, as c0, c1, ..., what is shuffled of the others; and
    how these are had again (from x.c0, ...).  Texts that are lower-case
    hexadecimal, as hashes are, go as bytes."""
    raw, schema, back = _slim_plan(rows, by)
    return raw.mapInArrow(_slimmer(raw.schema, schema, len(by)), schema), back


def _is_text(schema: StructType) -> list[bool]:
    """Of each column; texts with a collation are none, they stay as they are."""
    return [f.dataType.simpleString() == "string" for f in schema.fields]


def _slim_plan(rows: DataFrame, by: Sequence[str]) -> tuple[DataFrame, StructType, list[Column]]:
    """What ``_slimmer`` takes, the schema of what it gives, and how the
    columns are had again."""
    others = [f for f in rows.schema.fields if f.name not in by]
    sent, back = [], []
    for f, text in zip(others, _is_text(StructType(others))):
        at = len(sent)
        if not text:
            sent.append(StructField(f"c{at}", f.dataType))
            back.append(F.col(f"x.c{at}").alias(f.name))
        else:
            sent += [StructField(f"c{at}", BinaryType()), StructField(f"c{at + 1}", f.dataType)]
            back.append(F.coalesce(F.lower(F.hex(f"x.c{at}")), F.col(f"x.c{at + 1}")).alias(f.name))
    raw = rows.select(*by, *[F.col(f"`{f.name}`").alias(f"r{i}") for i, f in enumerate(others)])
    return raw, StructType(raw.schema.fields[:len(by)] + sent), back


def _slimmer(raw: StructType, slim: StructType, keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Makes batches of ``slim`` from those of ``raw``: after ``keys`` columns
    that stay, a text comes as its bytes, where it is hexadecimal, and itself."""
    names, texts = slim.names, _is_text(raw)[keys:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:keys]
            for column, text in zip(batch.columns[keys:], texts):
                columns += _hex_bytes(column) if text else [column]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


_NIBBLES = np.full(256, 255, np.uint8)
_NIBBLES[np.frombuffer(b"0123456789abcdef", np.uint8)] = np.arange(16)


def _hex_bytes(texts: pa.Array) -> list[pa.Array]:
    """The bytes that texts in lower-case hexadecimal stand for (null for other
    texts), and the other texts (null for these)."""
    def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The half-bytes of all texts (255: not hexadecimal), and their ends."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        return _NIBBLES[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.zeros(0, np.uint8)], ends - ends[0]

    texts = texts.cast(pa.string())
    if not len(texts):
        return [pa.nulls(0, pa.binary()), texts]
    half, ends = flat(texts)
    odd = ends[1:] - ends[:-1] & 1 == 1
    wrong = half == 255
    if wrong.any():
        before = np.concatenate([[0], np.cumsum(wrong)])[ends]
        odd |= before[1:] > before[:-1]
    if texts.null_count:
        odd |= texts.is_null().to_numpy(zero_copy_only=False)
    if odd.all():
        return [pa.nulls(len(texts), pa.binary()), texts]
    if odd.any():
        half, _ = flat(texts.filter(pa.array(~odd)))
    sizes = np.where(odd, 0, (ends[1:] - ends[:-1]) // 2)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    known = pa.py_buffer(np.packbits(~odd, bitorder="little")) if odd.any() else None
    found = pa.Array.from_buffers(pa.binary(), len(texts), [known, pa.py_buffer(offsets), pa.py_buffer(half[::2] << 4 | half[1::2])])
    others = texts.take(pa.array(np.arange(len(texts)), mask=~odd)) if odd.any() else pa.nulls(len(texts), pa.string())
    return [found, others]


_DIGITS = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint16)


def _texts(known: pa.Array, others: pa.Array) -> pa.Array:
    """The texts that ``_hex_bytes`` parted."""
    if known.null_count == len(known):
        return others
    ends = np.frombuffer(known.buffers()[1], np.int32)[known.offset:known.offset + len(known) + 1]
    digits = _DIGITS[np.frombuffer(known.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]]
    valid = pa.py_buffer(np.packbits(known.is_valid().to_numpy(zero_copy_only=False), bitorder="little")) if known.null_count else None
    found = pa.Array.from_buffers(pa.string(), len(known), [valid, pa.py_buffer((ends - ends[0]) * np.int32(2)), pa.py_buffer(digits)])
    return found if others.null_count == len(others) else pc.coalesce(found, others)


def _even(column: pa.ChunkedArray) -> pa.ChunkedArray:
    """Texts or bytes of one length without their offsets, which compress badly."""
    kind = column.type
    if not (pa.types.is_binary(kind) or pa.types.is_string(kind)) or column.null_count:
        return column
    shortest, longest = pc.min_max(pc.binary_length(column)).as_py().values()
    return column.cast(pa.binary()).cast(pa.binary(longest)) if longest and shortest == longest else column


def _sorted_places(keys: list[np.ndarray]) -> np.ndarray:
    """Where the rows in the order of whole numbers ``keys``, the first one's
    before the next one's, come from.  Numbers that fit into one are sorted as one."""
    room, ranges = 1, [(int(k.min()), int(k.max())) for k in keys]
    for low, high in ranges:
        room *= high - low + 1
    if room > 1 << 62:
        return np.lexsort(keys[::-1])
    one = np.zeros(len(keys[0]), np.int64)
    for k, (low, high) in zip(keys, ranges):
        one *= high - low + 1
        one += k - low
    return np.argsort(one, kind="stable")


def _chunked(rows: DataFrame, by: Sequence[str], packed: bool = False, then: str | None = None) -> tuple[DataFrame, list[Column]]:
    """Rows of arrays, each with rows of one task that agree in the whole
    numbers ``by``, and how the other columns are had from their elements (x).
    ``packed`` has the arrays as one compressed Arrow stream, ``chunk``, which
    ``_unpacked`` opens, sorted by ``then`` (c0, ...) in it."""
    by = list(by)
    raw, slim, back = _slim_plan(rows, by)
    slimmed, fields = _slimmer(raw.schema, slim, len(by)), slim.fields[len(by):]
    names = [f.name for f in fields]
    lists = [StructField("chunk", BinaryType())] if packed else [StructField(f.name, ArrayType(f.dataType)) for f in fields]
    schema = StructType(slim.fields[:len(by)] + lists)
    longest, most_rows, most_bytes = CHUNK_ROWS, HELD_ROWS, HELD_BYTES

    def stream(part: pa.Table) -> bytes:
        part, sink = pa.table([_even(c) for c in part.columns], names), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(part)
        return sink.getvalue().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            order = _sorted_places([table[c].to_numpy() for c in by + ([then] if then else [])])
            keys = [table[c].to_numpy()[order] for c in by]
            whole = pa.table([_even(c) if packed else c for c in table.select(names).columns], names).take(pa.array(order))
            starts = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            place = np.arange(len(table)) - np.repeat(starts, np.diff(np.append(starts, len(table))))
            starts = np.flatnonzero(place % longest == 0)
            ends = np.append(starts[1:], len(table))
            if packed:
                whole = whole.combine_chunks()
                return pa.RecordBatch.from_arrays(
                    [pa.array(k[starts]) for k in keys]
                    + [pa.array([stream(whole.slice(a, b - a)) for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())], by + ["chunk"])
            offsets = pa.array(np.append(starts, len(table)), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(k[starts]) for k in keys]
                + [pa.ListArray.from_arrays(offsets, pa.concat_arrays(whole[c].chunks)) for c in names], by + names)

        held, count, size = [], 0, 0
        for batch in slimmed(batches):
            if batch.num_rows:
                held.append(batch)
                count, size = count + batch.num_rows, size + batch.nbytes
            if count >= most_rows or size >= most_bytes:
                yield chunks(held)
                held, count, size = [], 0, 0
        if held:
            yield chunks(held)

    return raw.mapInArrow(run, schema), back


def _unpacked(chunks: DataFrame, schema: StructType, sort: str | None = None, whole: StructType | None = None) -> DataFrame:
    """The rows in packed ``chunks``, as structs x.  With ``sort``, chunks of one
    stretch (``_stretch``), which must follow each other, are opened together
    and their rows sorted; a task holds one stretch at a time.  With ``whole``,
    the schema that the rows had before ``_slimmer``, they are had again as they
    were, not in structs."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, most = to_arrow_schema(schema), CHUNK_ROWS
    final, texts = (to_arrow_schema(whole), _is_text(whole)) if whole else (None, [])

    def as_were(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = iter(part.columns)
        return pa.RecordBatch.from_arrays(
            [_texts(next(columns), next(columns).cast(pa.string())).cast(f.type) if text else next(columns) for f, text in zip(final, texts)],
            final.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: list[pa.Table]) -> list[pa.RecordBatch]:
            table = pa.concat_tables(parts)
            parts = (table.sort_by(sort) if sort else table).combine_chunks().to_batches(max_chunksize=16 * most)
            return list(map(as_were, parts)) if final else parts

        held, count, at = [], 0, None
        for batch in batches:
            stretches = batch["_stretch"].to_pylist() if sort else [None] * batch.num_rows
            for stretch, chunk in zip(stretches, batch["chunk"]):
                if held and (stretch != at if sort else count >= 16 * most):
                    yield from rows(held)
                    held, count = [], 0
                # a copy of its own: what is held must not keep the whole batch
                table = pa.ipc.open_stream(chunk.as_py()).read_all()
                held.append(pa.table([c.cast(pa.binary()).cast(f.type) if pa.types.is_fixed_size_binary(c.type) else c.cast(f.type)
                                      for c, f in zip(table.columns, arrow)], arrow))
                count, at = count + held[-1].num_rows, stretch
        if held:
            yield from rows(held)

    found = chunks.select(*(["_stretch"] if sort else []), "chunk").mapInArrow(run, whole or schema)
    return found if whole else found.select(F.struct("*").alias("x"))


def _write_numbered(rows: DataFrame, n: int, out: str, order: str | None = None) -> None:
    """Write ``rows`` (and their number below ``n``, ``_file``) as one file a
    number, each sorted by the column ``order`` (left out in the file), along
    which ``_stretch`` never falls.

    One task writes a file, so it reads all its rows, however large the table
    is.  What it reads and sorts is therefore kept close to the values: rows
    of one file and stretch move as compressed Arrow streams.  They are sorted
    by stretch as they are, and opened one stretch at a time."""
    by = ["_file"] + (["_stretch"] if order else [])
    if order:
        rows = rows.select(order, *[F.col(f"`{c}`") for c in rows.columns if c != order])
    moved = _chunked(rows, by, packed=True, then="c0" if order else None)[0].repartitionById(n, "_file")
    if order:
        moved = moved.sortWithinPartitions("_stretch")
    fields = StructType(_slim_plan(rows, by)[1].fields[len(by):])
    found = _unpacked(moved, fields, "c0" if order else None, StructType([f for f in rows.schema.fields if f.name not in by]))
    (found.drop(order) if order else found).write.mode("overwrite").parquet(out)


def detail(spark: SparkSession, path: str) -> DataFrame:
    """``num_files``, ``size_bytes``, ``num_rows`` of a Parquet table, from its
    files' footers: no data is read."""
    return footers(spark, path).agg(
        F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("size_bytes"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).cast("bigint").alias("num_rows"))


def compaction_holds(files: DataFrame, target_bytes: int, total_bytes: int, slack: float = 0.5) -> DataFrame:
    """One row ``holds``: the files (as from ``footers``) are at most as many
    as ``total_bytes`` takes at ``target_bytes`` each, none is larger than the
    target by more than ``slack`` of it, and each has at least 1 - ``slack`` of
    an even share of the rows."""
    asked = max(1, math.ceil(total_bytes / target_bytes))
    a = files.agg(F.count(F.lit(1)).alias("n"), F.max("file_size").alias("largest"), F.min("num_rows").alias("fewest"),
                  F.sum("num_rows").alias("rows"))
    return a.select(((F.col("n") > 0) & (F.col("n") <= asked) & (F.col("largest") <= (1 + slack) * target_bytes)
                     & (F.col("fewest") >= (1 - slack) * F.col("rows") / F.col("n"))).alias("holds"))


def in_key_order(rows: DataFrame, key: Column) -> DataFrame:
    """One row ``holds``: sorted by their smallest key, no file of ``rows``
    (a Parquet read) has a key above the next file's smallest.  One aggregate to
    a row per file; the window runs over these."""
    files = rows.select(F.col("_metadata.file_path").alias("f"), key.alias("k")).groupBy("f").agg(
        F.min("k").alias("low"), F.max("k").alias("high"))
    after = F.lead("low").over(Window.orderBy("low", "high", "f"))
    return files.select((F.col("high") <= after).alias("ok")).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("holds"))


def in_zorder(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """``in_key_order`` of a stored table under the Morton key of ``cols``."""
    rows = spark.read.parquet(path)
    return in_key_order(rows, zorder_key(rows, list(cols)))


def boxes_hold(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """One row ``holds``: in every file, the footer's rows and min/max of
    ``cols`` are those of the rows that it holds."""
    said, seen = footers(spark, path, cols), manifest(spark, path, cols)
    names = ["num_rows"] + [f"{end}_{c}" for c in cols for end in ("min", "max")]
    tagged = [df.filter("num_rows > 0").select(F.regexp_replace("file_path", "^file:/+", "/").alias("f"), *names) for df in (said, seen)]
    odd = tagged[0].exceptAll(tagged[1]).unionByName(tagged[1].exceptAll(tagged[0]))
    return odd.agg((F.count(F.lit(1)) == 0).alias("holds"))


def _file_count(spark: SparkSession, path: str, target_bytes: int) -> int:
    size = detail(spark, path).first()["size_bytes"] or 0
    return max(1, math.ceil(size / target_bytes))


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = DEFAULT_TARGET_BYTES,
            cluster_by: Sequence[str] = ()) -> int:
    """Rewrite into ``ceil(bytes/target)`` files; returns the file count."""
    n = _file_count(spark, path, target_bytes)
    df = spark.read.parquet(path)
    if cluster_by:
        # row hash as last range key: a hot clustering value still spreads
        # over several files instead of landing in one task
        (df.withColumn("_tb", _row_hash(df)).repartitionByRange(n, *cluster_by, "_tb")
         .sortWithinPartitions(*cluster_by).drop("_tb").write.mode("overwrite").parquet(out))
    else:  # dealt in turn, file by file
        turn = F.xxhash64("_metadata.file_path") + F.col("_metadata.row_index")
        _write_numbered(df.withColumn("_file", F.pmod(turn, F.lit(n)).cast("int")), n, out)
    return n


def zorder(spark: SparkSession, path: str, out: str, cols: Sequence[str],
           target_bytes: int = DEFAULT_TARGET_BYTES, n_files: int | None = None) -> int:
    """Compact and cluster on the Morton key of ``cols`` into files of equal
    row counts; returns file count.

    Rows sharing one Z value (a hot date x type cell) split over the files
    that its places in key order fall to, each row by its hash; such a file's
    box stays one Z value wide."""
    n = n_files or _file_count(spark, path, target_bytes)
    df = spark.read.parquet(path)
    number = _share(2 * _spot(), n)
    _write_numbered(_beside_cells(df, cols, _placed).select(*_columns(df), "_z", number.alias("_file"), _stretch()), n, out, "_z")
    return n


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _spot() -> Column:
    """A row's place in key order, by its hash within its cell's."""
    return F.col("_before") + F.pmod("_tb", "_n")


def _stretch() -> Column:
    return F.shiftright(_spot(), STRETCH_BITS).alias("_stretch")


def _placed(cells: DataFrame) -> DataFrame:
    """Cells (_z, _n) with the rows before each in key order and of all.  The
    window runs over the cells, a row each, never over data rows."""
    order = Window.orderBy("_z")
    upto, total = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.sum("_n").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return cells.select("_z", "_n", (upto - F.col("_n")).alias("_before"), total.alias("_total"))


def _share(twice: Column, n_files: int) -> Column:
    """Which of ``n_files`` equal shares of the ``_total`` rows a row's place,
    which is given doubled, lies in, in whole numbers."""
    scaled = twice * n_files
    return ((scaled - F.pmod(scaled, 2 * F.col("_total"))) / (2 * F.col("_total"))).cast("int")


def _beside_cells(df: DataFrame, cols: Sequence[str], placed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows with their Morton key ``_z``, their hash ``_tb`` and the columns
    that ``placed`` gives to their cell, from the cells' row counts (_z, _n).

    Keys are worked out for the combinations of values that occur, not row by
    row.  Up to ``LISTED_VALUES`` combinations are broadcast with their cells;
    beyond that rows get keys of their own and meet the cells, of which two
    columns have a million at most: they are broadcast too.  So the rows
    aren't shuffled for it."""
    checkpoint_root(df.sparkSession)
    values = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    key = zorder_key(values, list(cols))
    cells = placed(values.select(key.alias("_z"), "_n").groupBy("_z").agg(F.sum("_n").alias("_n")))
    rows = df.withColumn("_tb", _row_hash(df))
    if values.count() > LISTED_VALUES:
        return rows.withColumn("_z", key).join(F.broadcast(cells) if len(cols) * CELL_BITS <= 20 else cells, "_z")
    known = values.select(key.alias("_z"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)]).join(cells, "_z")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_v{i}")) for i, c in enumerate(cols)])
    return rows.join(F.broadcast(known), same)


def cell_files(cells: DataFrame, n_files: int) -> DataFrame:
    """Rows (_z, _n) of cells and their row counts -> _z, _first, _files: which
    of ``n_files`` equal shares of the rows, in key order, a cell goes to; with
    _n and _before, the rows before it.

    A cell goes whole to the share that holds its middle row; one that is
    larger than a share is dealt over all the shares it covers."""
    placed = _placed(cells)
    first, last, middle = (_share(x, n_files) for x in (2 * F.col("_before"), 2 * (F.col("_before") + F.col("_n") - 1),
                                                        2 * F.col("_before") + F.col("_n") - 1))
    large = F.col("_n") * n_files > F.col("_total")
    return placed.select("_z", F.when(large, first).otherwise(middle).alias("_first"),
                         F.when(large, last - first + 1).otherwise(1).alias("_files"), "_n", "_before")


def zorder_cells(spark: SparkSession, path: str, out: str, cols: Sequence[str],
                 target_bytes: int = DEFAULT_TARGET_BYTES, n_files: int | None = None) -> int:
    """``zorder`` with files cut at whole cells of the Morton grid, so the same
    rows give the same files on any cluster, and what a window reads can be said
    beforehand."""
    n = n_files or _file_count(spark, path, target_bytes)
    df = spark.read.parquet(path)
    number = F.col("_first") + F.pmod(F.col("_tb"), F.col("_files")).cast("int")
    rows = _beside_cells(df, cols, lambda cells: cell_files(cells, n))
    _write_numbered(rows.select(*_columns(df), "_z", number.alias("_file"), _stretch()), n, out, "_z")
    return n


def benchmark(spark: SparkSession, path: str, col: str, lo, hi) -> DataFrame:
    """One row: what a window on ``col`` costs in this layout, by the files'
    own footers, and what it returns."""
    files = footers(spark, path, [col])
    hit = F.coalesce(_overlap(col, lo, hi), F.lit(False))
    cost = files.agg(
        F.count(F.lit(1)).alias("files_total"), F.count_if(hit).alias("files_read"), F.count_if(~hit).alias("files_pruned"),
        F.coalesce(F.sum("num_rows"), F.lit(0)).alias("rows_total"),
        F.coalesce(F.sum(F.when(hit, F.col("num_rows"))), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(hit, F.col("file_size"))), F.lit(0)).alias("bytes_read")).first()
    found = spark.read.parquet(path).filter(F.col(col).between(F.lit(lo), F.lit(hi))).agg(F.count(F.lit(1)).alias("window_rows"))
    return found.select(*[F.lit(cost[c]).alias(c) for c in cost.asDict()], "window_rows")


def manifest(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """Per-file rows, bytes and min/max of ``cols`` (one aggregate)."""
    df = spark.read.parquet(path)
    aggs = [F.first(F.col("_metadata.file_size")).alias("file_size"), F.count(F.lit(1)).alias("num_rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*aggs)


def write_manifest(spark: SparkSession, path: str, cols: Sequence[str], out: str | None = None) -> str:
    out = out or path.rstrip("/") + "__manifest"
    manifest(spark, path, cols).write.mode("overwrite").parquet(out)
    return out


def _overlap(col: str, lo, hi):
    return ~((F.col(f"max_{col}") < F.lit(lo)) | (F.col(f"min_{col}") > F.lit(hi)))


def profile(manifest_df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Files/bytes/rows read vs pruned for ``col BETWEEN lo AND hi``."""
    hit = _overlap(col, lo, hi)
    return manifest_df.agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(hit).alias("files_read"),
        F.count_if(~hit).alias("files_pruned"),
        F.sum(F.when(hit, F.col("file_size")).otherwise(0)).cast("bigint").alias("bytes_read"),
        F.sum(F.when(~hit, F.col("file_size")).otherwise(0)).cast("bigint").alias("bytes_pruned"),
        F.sum(F.when(hit, F.col("num_rows")).otherwise(0)).cast("bigint").alias("rows_read"),
    )


def box_rows(files: DataFrame, col: str, lo, hi) -> DataFrame:
    """One row: ``rows_total`` of the files (as from ``footers``), and
    ``box_rows``, those of the files whose own min/max of ``col`` overlap
    [lo, hi]."""
    rows = F.coalesce(F.sum(F.when(_overlap(col, lo, hi), F.col("num_rows"))), F.lit(0))
    return files.agg(F.coalesce(F.sum("num_rows"), F.lit(0)).alias("rows_total"), rows.alias("box_rows"))


def opened(spark: SparkSession, path: str, manifest_path: str, col: str, lo, hi, schema=None) -> DataFrame:
    """All rows of the files that ``skipping_scan`` opens.

    Up to ``LISTED_FILES`` kept files are given to the reader as paths, so no
    other file is opened.  More of them are joined by path, which reads the
    table under its usual pruning and keeps their rows: no list on the driver
    grows with the files.
    """
    kept = spark.read.parquet(manifest_path).filter(_overlap(col, lo, hi)).select("file_path")
    schema = schema or spark.read.parquet(path).schema
    few = [r["file_path"] for r in kept.take(LISTED_FILES + 1)]
    if not few:
        return spark.createDataFrame([], schema)
    if len(few) <= LISTED_FILES:
        return spark.read.schema(schema).parquet(*few)
    rows = spark.read.schema(schema).parquet(path)
    return rows.withColumn("_file", F.col("_metadata.file_path")).join(
        kept.withColumnRenamed("file_path", "_file"), "_file", "left_semi").drop("_file")


def skipping_scan(spark: SparkSession, path: str, manifest_path: str, col: str, lo, hi,
                  schema=None) -> DataFrame:
    """Scan only the files whose [min, max] of ``col`` overlaps [lo, hi]; the
    predicate is still applied (and pushed down) on top."""
    return opened(spark, path, manifest_path, col, lo, hi, schema).filter(F.col(col).between(F.lit(lo), F.lit(hi)))


def compared(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two one-row frames of measures, side by side: measure, before, after
    and change, the relative difference (NULL without a base to relate to)."""
    names = [c for c in before.columns if c in after.columns]

    def measures(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.explode(F.create_map(*[x for c in names for x in (
            F.lit(c), F.col(c).cast("double"))])).alias("measure", name))

    return (measures(before, "before").join(measures(after, "after"), "measure", "full")
            .withColumn("change", F.try_divide(F.col("after") - F.col("before"), F.col("before"))))
