"""Raw landing: read a CSV batch as all-string columns and stamp it.

Bronze keeps the source untouched: every source column is a STRING, the names
come from the file header, nothing is inferred.  Two metadata columns are
added per batch: ``_source_file`` (the idempotency key) and ``_load_ts`` (the
arrival clock, one driver-side value for the whole batch).
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ledgerline.functions.columns import as_ntz

SOURCE_FILE_COL = "_source_file"
LOAD_TS_COL = "_load_ts"
CORRUPT_COL = "_corrupt_record"

# The raw transaction columns, in source order.
RAW_COLUMNS = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
)

# Account-id columns that must exist so the mask can be bound.
PII_COLUMNS = ("nameOrig", "nameDest")

# Strings the reference's CSV reader turns into NULL by default
# (the pandas ``read_csv`` default NA set), so a landed batch has the same NULLs.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The characters of a folder or file name in a source name.
_NAME_CHARACTERS = frozenset(string.ascii_letters + string.digits + "._-")


# Fixed value: how Spark names the partition folder of NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def validate_source_name(source_file: str) -> str:
    """A source name is a relative path: parts of plain characters, none of
    them empty (so it can't start at the root) or leading upwards."""
    parts = source_file.split("/") if isinstance(source_file, str) else [""]
    for part in parts:
        if not part or ".." in part or not _NAME_CHARACTERS.issuperset(part):
            raise ValueError(f"bad part {part!r} in source name {source_file!r}")
    if source_file == NULL_PARTITION:
        raise ValueError(f"source name {source_file!r} is the folder name of a missing value")
    return source_file


def bronze_schema(columns: Sequence[str], pii: Iterable[str] = PII_COLUMNS) -> StructType:
    """All source columns STRING, plus the two metadata columns.

    Refuses when a PII column is missing: bronze must never exist without the
    columns the mask is bound to.
    """
    missing = [c for c in pii if c not in columns]
    if missing:
        raise ValueError(f"refusing to build bronze without mask columns {missing}; "
                         f"source has {list(columns)}")
    fields = [StructField(c, StringType(), True) for c in columns
              if c not in (SOURCE_FILE_COL, LOAD_TS_COL)]
    fields += [StructField(SOURCE_FILE_COL, StringType(), True),
               StructField(LOAD_TS_COL, TimestampNTZType(), True)]
    return StructType(fields)


def na_to_null(col: str, na_strings: Sequence[str] = NA_STRINGS) -> Column:
    c = F.col(col)
    return F.when(c.isin(*na_strings), F.lit(None).cast("string")).otherwise(c)


def read_raw(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
             na_strings: Sequence[str] | None = NA_STRINGS, fail_long_rows: bool = True,
             allow_empty: bool = False, multi_line: bool = False,
             extra: Sequence[Column] = ()) -> DataFrame:
    """Read headed CSV files or folders with every column a string.

    Columns go by the names in the header.  ``columns`` pins which ones there
    must be, in any order, and gives the order of the result; every file's
    own header is held against the first one's, so a file whose columns are
    ordered differently fails instead of landing swapped.  Short rows are
    padded with NULL; a row with more fields than the header fails the batch.
    An empty source is an error unless ``allow_empty``.  ``multi_line``
    accepts quoted fields with line breaks; it is off by default because it
    makes every file a single, unsplittable task.  ``extra`` columns (of the
    file metadata) are added.
    """
    paths = [path] if isinstance(path, str) else list(path)
    header = spark.read.option("header", "true").option("escape", '"').csv(paths).columns
    if columns is not None and sorted(columns) != sorted(header):
        raise ValueError(f"header {header} of {paths[0]} doesn't have the columns {list(columns)}")
    reader = (spark.read.option("header", "true").option("escape", '"').option("enforceSchema", "false")
              .option("multiLine", "true" if multi_line else "false")
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL))
    schema = StructType([StructField(c, StringType(), True) for c in [*header, CORRUPT_COL]])
    df = reader.schema(schema).csv(paths)
    if fail_long_rows:
        # a filter, so that no projection of the result can drop the check
        df = df.filter(long_row_guard(header).otherwise(F.lit(True)))
    df = df.select(*[(na_to_null(c, na_strings) if na_strings else F.col(c)).alias(c) for c in columns or header], *extra)
    if not allow_empty and df.isEmpty():
        raise ValueError(f"source {path} parsed to 0 rows; refusing to land an empty batch")
    return df


def long_row_guard(columns: Sequence[str]) -> Column:
    """``CASE WHEN <row has more fields than the header> THEN raise_error``."""
    wide = ", ".join(f"`c{i}` STRING" for i in range(len(columns) + 1))
    extra = F.from_csv(F.col(CORRUPT_COL), wide, {"escape": '"'}).getField(f"c{len(columns)}")
    is_long = F.col(CORRUPT_COL).isNotNull() & extra.isNotNull()
    # (a parsed column is named too: Spark refuses to read the corrupt record alone)
    msg = F.concat(F.lit(f"row longer than the header ({len(columns)} fields): "), F.col(CORRUPT_COL),
                   F.lit(" near "), F.coalesce(F.col(columns[0]), F.lit("")))
    return F.when(is_long, F.raise_error(msg).cast("boolean"))


def now_utc() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stamp(df: DataFrame, source_file: str, load_ts: datetime | str | None = None) -> DataFrame:
    """Add ``_source_file`` and one ``_load_ts`` for the whole batch.

    The stamp is taken once on the driver and travels as a literal, so every
    row of the batch carries the identical value on every executor.
    """
    validate_source_name(source_file)
    load_ts = load_ts if load_ts is not None else now_utc()
    return df.withColumns({SOURCE_FILE_COL: F.lit(source_file), LOAD_TS_COL: as_ntz(load_ts)})
