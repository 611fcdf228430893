"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

# White space everywhere in this subpackage: space and U+0009 to U+000D.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    This fixes generated ids and sampled boundaries and cuts the lineage: a
    lost executor re-reads the files, it never recomputes them differently.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


FILTER_BITS = 24


def maybe_among(values: DataFrame, column: str, most_bits: int = FILTER_BITS):
    """A test for use in ``filter``: false only for values that aren't in the
    column of ``values``.  It is a Bloom filter (two hashes) of 16 to 32 bits a
    value, but of at most 2^``most_bits`` bits (2 MB) whatever their number,
    made by aggregates and read as a scalar subquery: broadcast data of a
    bounded size.  Rows that pass still have to be joined."""
    bits = min(most_bits, max(10, (16 * values.count()).bit_length()))

    def places(value: Column) -> list[Column]:
        return [F.shiftrightunsigned(F.xxhash64(F.lit(seed), value), 64 - bits) for seed in (0, 1)]

    def word(place: Column) -> Column:
        return F.shiftright(place, 6)

    spark = values.sparkSession
    set_bits = values.select(F.explode(F.array(*places(F.col(column)))).alias("p")).groupBy(word(F.col("p")).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("set"))
    words = spark.range(1 << (bits - 6)).join(set_bits, "id", "left").select("id", F.coalesce("set", F.lit(0).cast("long")).alias("set"))
    whole = stored(words.agg(F.array_sort(F.collect_list(F.struct("id", "set")))["set"].alias("words")), "bloom-filter")

    def test(value: Column) -> Column:
        held, (one, two) = whole.scalar(), places(value)

        def has(place: Column) -> Column:
            return F.getbit(F.get(held, word(place).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1

        return has(one) & has(two)

    return test


@cache
def _package(application: str) -> str:
    """A zip of this package for the executors of one application."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    return path


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package sent to the executors, which need not
    have it installed."""
    context = df.sparkSession.sparkContext
    if not any(f.endswith("/ledgerline.zip") for f in context.listFiles):
        context.addPyFile(_package(context.applicationId))
    return df.mapInArrow(run, schema)


def with_row_ids(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Store ``docs`` with a row id: columns rid, doc_id, text, row.

    ``row`` is the whole input row, so input columns of any name survive
    unchanged (``select("row.*")``) and cannot clash with working columns.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row"))
    kept = stored(keyed, "rows")
    return kept.select("rid", F.col(f"row.`{doc_id}`").alias("doc_id"),
                       F.col(f"row.`{text}`").alias("text"), "row")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), use), 0)


def prefix_sums(values: Column) -> Column:
    """Running totals (each including its own element) of an array of ints.

    Blocks of about sqrt(n) elements keep the work at n^1.5 lambda steps, so
    an array of 100,000 elements is still cheap.
    """
    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def plain(xs: Column) -> Column:
        return F.transform(xs, lambda _, i: total(F.slice(xs, F.lit(1), i + 1)))

    def shifted(block: Column, end: Column) -> Column:
        return bound(plain(block), lambda own: F.transform(own, lambda v: v + end - F.element_at(own, -1)))

    def blocked(xs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(xs))).cast("int")
        cut = F.transform(F.sequence(F.lit(0), ((F.size(xs) - 1) / width).cast("int")),
                          lambda b: F.slice(xs, b * width + 1, width))
        return bound(cut, lambda blocks: F.flatten(F.zip_with(blocks, plain(F.transform(blocks, total)), shifted)))

    return bound(values, lambda xs: F.when(F.size(xs) == 0, F.array().cast("array<int>"))
                 .when(F.size(xs) <= 32, plain(xs)).otherwise(blocked(xs)))


SPAN = "array<struct<s:int,rank:int,e:int,kind:string>>"


def spans_of(hits: Column, pieces: Column, kind: str, rank: int, valid=None) -> Column:
    """Spans (code points, end exclusive) from the matches of a pattern and
    the text between them: ``regexp_extract_all`` and ``split`` with limit -1
    of one text by one pattern.  ``valid`` drops matches by their text."""
    widths = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(pieces, i)))
    found = F.arrays_zip(hits.alias("h"), prefix_sums(widths).alias("end"))
    if valid is not None:
        found = F.filter(found, lambda p: valid(p["h"]))
    return F.transform(found, lambda p: F.struct(
        (p["end"] - F.length(p["h"])).cast("int").alias("s"), F.lit(rank).alias("rank"),
        p["end"].cast("int").alias("e"), F.lit(kind).alias("kind"))).cast(SPAN)


@dataclass(frozen=True)
class Rule:
    """A kind of span: a Java regular expression; ``valid`` drops matches by
    their text; ``needs`` is a string that every match contains."""
    kind: str
    pattern: str
    valid: Callable[[Column], Column] | None = None
    needs: str = ""


def matches(text: Column, rules: Sequence[tuple[int, Rule]], wanted: Column | None = None) -> dict[str, Column]:
    """Columns with the matches in ``text`` of each numbered rule, or only of
    those whose numbers are in the array ``wanted``."""
    out = {}
    for rank, rule in rules:
        hits, on = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.lit(True)
        if wanted is not None:
            on = on & F.array_contains(wanted, rank)
        if rule.needs:
            on = on & F.contains(text, F.lit(rule.needs))
        out[f"hits{rank}"] = F.when(on, hits).otherwise(F.array().cast("array<string>"))
    return out


def located(text: Column, rules: Sequence[tuple[int, Rule]]) -> Column:
    """The spans of the columns that ``matches`` made."""
    parts = [no_spans()]
    for rank, rule in rules:
        hits = F.col(f"hits{rank}")
        parts.append(F.when(F.size(hits) > 0, spans_of(
            hits, F.split(text, rule.pattern, -1), rule.kind, rank, rule.valid)).otherwise(no_spans()))
    return F.concat(*parts)


def no_spans() -> Column:
    return F.array().cast(SPAN)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then by the kinds' order, comma-joined."""
    parts = F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(parts, ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in angle brackets;
    overlapping spans are replaced together, under the first one's kind."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["pos"] + 1, x["s"] - acc["pos"])
        inside = x["s"] < acc["pos"]
        return F.struct(
            F.greatest(acc["pos"], x["e"]).alias("pos"),
            F.when(inside, acc["out"]).otherwise(F.concat(
                acc["out"], F.array(gap, F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))))).alias("out"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with spaces in place of its spans; all offsets stay."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        end = F.greatest(acc["pos"], x["e"])
        gap = F.substring(text, acc["pos"] + 1, F.greatest(x["s"] - acc["pos"], F.lit(0)))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(
            gap, F.repeat(F.lit(" "), end - F.greatest(acc["pos"], x["s"])))).alias("out"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))
