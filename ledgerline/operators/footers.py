"""What the files of a Parquet table say of themselves, read from their
footers: rows, bytes, row groups, and each column's smallest and largest value.

A footer is a few kilobytes at the end of a file, and no page of data is read,
so this costs the same however large the files are.  The DataFrame reader can't
return footers, so the listing (Spark's, with its rules on hidden files) is dealt
over tasks which read them with pyarrow, each file by itself.  The store
must be one that ``pyarrow.fs`` can open: local or shared folders, HDFS, S3,
GCS, Azure.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

FILES_PER_TASK = 200


def footers(spark: SparkSession, path: str, cols: Sequence[str] = ()) -> DataFrame:
    """One row per data file: ``file_path``, ``file_size``, ``num_rows``,
    ``row_groups``, and ``min_c``, ``max_c`` of each column (NULL where the file
    has only NULLs, or a row group without statistics, in it)."""
    from pyspark.sql.pandas.types import to_arrow_type

    cols = list(cols)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select(F.col("path").alias("file_path"), F.col("length").alias("file_size")))
    types = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields} if cols else {}
    fields = files.schema.fields + [StructField(c, files.schema["file_size"].dataType) for c in ("num_rows", "row_groups")]
    fields += [StructField(f"{end}_{c}", types[c]) for c in cols for end in ("min", "max")]
    arrow = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in fields]

    def box(meta, number: int) -> tuple:
        """Smallest and largest value of one column over the row groups."""
        low = high = None
        for g in range(meta.num_row_groups):
            chunk = meta.row_group(g).column(number)
            stats = chunk.statistics
            if stats is not None and stats.has_null_count and stats.null_count == chunk.num_values:
                continue
            if stats is None or not stats.has_min_max:
                return None, None
            low = stats.min if low is None else min(low, stats.min)
            high = stats.max if high is None else max(high, stats.max)
        return low, high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for uri, size in zip(batch["file_path"].to_pylist(), batch["file_size"].to_pylist()):
                store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
                with store.open_input_file(at) as source:
                    meta = pq.read_metadata(source)
                place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
                rows.append([uri, size, meta.num_rows, meta.num_row_groups] + [x for c in cols for x in box(meta, place[c])])
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), arrow)], names)

    count = files.count()
    return files.repartition(max(1, -(-count // FILES_PER_TASK))).mapInArrow(run, StructType(fields))
