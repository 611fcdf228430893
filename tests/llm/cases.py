"""Small documents that every operator and stage must handle."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                     StructField("lang", StringType()), StructField("source", StringType()),
                     StructField("n_chars", LongType())])
PROSE = ("The quick brown fox jumps over the lazy dog near the old river bank. "
         "Every morning the farmer walks along a quiet road and greets all of his neighbours. "
         "Nobody knows why the tower bells ring twice on sundays, yet visitors enjoy the sound. "
         "Later in spring, small boats carry fresh fruit and bread across the wide green lake. ")
LONG = " ".join(f"word{i % 977} and thing{i}" for i in range(20_000))
TEXTS = [PROSE, None, "", " \t\n ", PROSE, PROSE.replace(" ", "  "), PROSE.upper(), "one", LONG, LONG,
         "añb ☃ 𝄞 ümlaut", "0123456789" * 500, "a" * 20_000, "\n".join(["same line here"] * 40), "#" * 300 + " | | |"]


def rows(extra: bool = False) -> list[tuple]:
    out = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    out += [(4, PROSE, "en", "s", len(PROSE)), (None, PROSE, None, None, None), (None, None, None, None, None),
            (7, "one", "en", "s", 3), (7, "another text", "en", "s", 12)]
    return [r + (5, "x", True) for r in out] if extra else out


def docs(spark, data=None, extra: bool = False):
    schema = SCHEMA
    if extra:
        schema = StructType(SCHEMA.fields + [StructField(n, t) for n, t in (
            ("rid", LongType()), ("row", StringType()), ("kept", StringType()))])
        data = [r[:-1] + ("yes",) for r in rows(True)] if data is None else data
    return spark.createDataFrame(rows() if data is None else data, schema)


def written(spark, tmp, data=None, extra: bool = False) -> str:
    """A data folder whose documents.parquet has these rows."""
    docs(spark, data, extra).coalesce(2).write.parquet(f"{tmp}/documents.parquet")
    return tmp
