"""Landed JSON pages: an envelope ``{results: [...], num_pages, num_results}`` per line or per file."""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import repeat

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .. import schemas
from ..functions.predicates import between_dates
from .tables import stage

# Python workers get the functions themselves, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def envelope(record: StructType) -> StructType:
    return StructType(
        [
            StructField("results", ArrayType(record)),
            StructField("num_pages", IntegerType()),
            StructField("num_results", IntegerType()),
        ]
    )


_UNREADABLE = "_unreadable"


def _envelopes(spark: SparkSession, path: str, record: StructType, multi_line: bool) -> DataFrame:
    """Pages, with the text of those that are not wholly readable."""
    schema = envelope(record).add(_UNREADABLE, StringType())
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", _UNREADABLE).json(path, multiLine=multi_line)


def _arrival() -> Column:
    # Rows of one file block are read in order by one task, so the running id orders them.
    page = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return F.struct(*[c.alias(n) for c, n in zip(page, ("file", "block", "page"), strict=True)])


def parsed_pages(spark: SparkSession, path: str, record: StructType, multi_line: bool = False, arrival: bool = True) -> DataFrame:
    """The records of all pages and the pages that cannot be read, staged: text is parsed once for ``page_rejects`` and ``read_pages``.

    A row per record, with its place in the page (``_pos``) and where ``arrival`` is asked for the page's (``_at``), or per
    unreadable page (``_reject``).
    """
    pages = _envelopes(spark, path, record, multi_line)
    bad = F.col(_UNREADABLE).isNotNull() & F.col("results").isNull()
    reject = F.when(bad, F.struct(F.col("_metadata.file_path").alias("file"), F.col(_UNREADABLE).alias("text"))).alias("_reject")
    # columns of the file are there only where it is read
    named = pages.select("results", reject, *([_arrival().alias("_at")] if arrival else []))
    rows = named.select(*[c for c in named.columns if c != "results"], F.posexplode_outer("results").alias("_pos", "r"))
    return stage(rows.where(F.col("_pos").isNotNull() | F.col("_reject").isNotNull()).select(*[c for c in rows.columns if c != "r"], "r.*"))


def read_pages(
    spark: SparkSession, path: str, record: StructType, multi_line: bool = False, arrival: str | None = None, parsed: DataFrame | None = None
) -> DataFrame:
    """One row per element of ``results``; a page with no results gives none, nor does one of ``page_rejects``.

    One envelope per line lets Spark split large files. ``multi_line`` is for one
    pretty-printed envelope per file, which a single task has to read. ``arrival`` names a column that
    orders records as they arrived: by file name, page in the file, and place in the page. ``parsed``: the ``parsed_pages`` of the path,
    if they are needed more than once.
    """
    if parsed is not None:
        places = [F.struct("_at", "_pos").alias(arrival)] if arrival else []
        return parsed.where(F.col("_pos").isNotNull()).select(*record.names, *places)
    pages = _envelopes(spark, path, record, multi_line)
    if arrival is None:
        return pages.select(F.explode("results").alias("r")).select("r.*")
    named = pages.select("results", _arrival().alias("_at"))
    return named.select("_at", F.posexplode("results").alias("_pos", "r")).select(
        "r.*", F.struct("_at", "_pos").alias(arrival)
    )


def page_rejects(spark: SparkSession, path: str, record: StructType, multi_line: bool = False, parsed: DataFrame | None = None) -> DataFrame:
    """``file, text`` of pages whose records cannot be read, such as one that was cut short."""
    if parsed is not None:
        return parsed.where(F.col("_reject").isNotNull()).select("_reject.*")
    pages = _envelopes(spark, path, record, multi_line)
    bad = pages.select(F.col("_metadata.file_path").alias("file"), "results", _UNREADABLE)
    return bad.where(F.col(_UNREADABLE).isNotNull() & F.col("results").isNull()).select("file", F.col(_UNREADABLE).alias("text"))


def page_count(spark: SparkSession, path: str) -> int:
    """Lines that are not empty."""
    # a page is long and seldom starts with many blanks: the whole of it is only looked at if it does
    starts = F.trim(F.substring("value", 1, 64)) != ""
    return spark.read.text(path).where(starts | (F.length(F.trim("value")) > 0)).count()


# A page's number in its file or folder name, as in ``page-0007.json`` or ``page=7/``.
PAGE_IN_NAME = r"(?i)^(.*)page[-_=]?(\d+)"


def landed_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``request, page, part, n_records, num_pages, num_results`` of every page that can be read.

    A page's number stands in its envelope (``page``) or in its name; the pages of a request lie in one folder, or have names that are alike up
    to the number. Without a number a request is a file, and its pages can only be counted. A large page can land in parts: envelopes with its
    number, each with another ``part``.
    """
    schema = StructType(
        [
            StructField("results", ArrayType(StringType())),
            *[StructField(c, IntegerType()) for c in ("num_pages", "num_results", "page")],
            StructField("part", LongType()),
            StructField(_UNREADABLE, StringType()),
        ]
    )
    pages = spark.read.schema(schema).option("columnNameOfCorruptRecord", _UNREADABLE).json(path, multiLine=multi_line)
    file = F.col("_metadata.file_path")
    pages = pages.select(file.alias("file"), *schema.names)
    named = F.regexp_extract("file", PAGE_IN_NAME, 2).try_cast("int")
    folder = F.regexp_extract("file", "^(.*)/", 1)
    request = F.when(F.col("page").isNotNull(), folder).when(named.isNotNull(), F.regexp_extract("file", PAGE_IN_NAME, 1)).otherwise(F.col("file"))
    good = pages.where(F.col(_UNREADABLE).isNull())
    return good.select(request.alias("request"), F.coalesce("page", named).alias("page"), "part", F.greatest(F.coalesce(F.size("results"), F.lit(0)), F.lit(0)).alias("n_records"), "num_pages", "num_results")


def page_gaps(landed: DataFrame) -> DataFrame:
    """What is missing of each request by its own count: ``request, kind, first, last, missing, detail``.

    ``pages``: a run of pages of ``landed_pages`` that no page was read for, from ``first`` to ``last``; for a request without
    page numbers only how many. ``records``: all pages are there, but hold fewer records than ``num_results``. The largest count that a
    request's pages state holds, as a listing may grow while it is paged; a page that states none stands for one that is there. A page that landed
    twice counts once, and one behind the last does no harm; the records of its parts add up, each part once. Numbers stay numbers: a run of missing pages is one row, however long.
    """
    if "part" not in landed.columns:
        landed = landed.withColumn("part", F.lit(None).cast("long"))
    parts = landed.where("page is not null").groupBy("request", "page", "part").agg(*[F.max(c).alias(c) for c in ("n_records", "num_pages", "num_results")])
    # the whole page, or its parts together
    whole, in_parts = F.max(F.expr("if(part is null, n_records, 0)")), F.sum(F.expr("if(part is null, 0, n_records)"))
    pages = parts.groupBy("request", "page").agg(
        F.greatest(whole, in_parts).alias("n_records"), F.max("num_pages").alias("num_pages"), F.max("num_results").alias("num_results")
    )
    stated = pages.groupBy("request").agg(
        F.max("num_pages").alias("pages"), F.max("num_results").alias("results"), F.sum("n_records").alias("records"), F.count(F.lit(1)).alias("seen")
    )
    # the place behind the last page closes the last gap
    ends = stated.select("request", (F.greatest("pages", F.lit(0)) + 1).alias("page"))
    before = F.lag("page", 1, 0).over(Window.partitionBy("request").orderBy("page"))
    places = pages.select("request", "page").unionByName(ends).join(stated, "request").where(F.col("page") <= F.col("pages") + 1)
    runs = places.withColumn("first", before + 1).where(F.col("first") < F.col("page"))
    lost = runs.select("request", "first", (F.col("page") - 1).alias("last"), F.col("page") - F.col("first"), "pages")
    lost = lost.toDF("request", "first", "last", "missing", "pages")
    span = F.when(F.col("first") == F.col("last"), F.concat(F.lit("page "), F.col("first"))).otherwise(F.concat(F.lit("pages "), F.col("first"), F.lit("-"), F.col("last")))
    lost = lost.select("request", F.lit("pages").alias("kind"), "first", "last", F.col("missing").cast("long"), F.concat(span, F.lit(" of "), F.col("pages")).alias("detail"))

    none = F.lit(None).cast("int")
    short = stated.join(lost.select("request").distinct(), "request", "left_anti").where(F.col("records") < F.col("results"))
    few = lambda have, want: F.concat(have, F.lit(" of "), want)
    short = short.select(
        "request", F.lit("records").alias("kind"), none.alias("first"), none.alias("last"), (F.col("results") - F.col("records")).alias("missing"),
        F.concat(few(F.col("records"), F.col("results")), F.lit(" records")).alias("detail"),
    )
    counted = landed.where("page is null").groupBy("request").agg(
        F.max("num_pages").alias("pages"), F.max("num_results").alias("results"), F.sum("n_records").alias("records"), F.count(F.lit(1)).alias("seen")
    )
    lacks_pages = F.coalesce(F.col("seen") < F.col("pages"), F.lit(False))
    unnumbered = counted.where(lacks_pages | (F.col("records") < F.col("results"))).select(
        "request",
        F.when(lacks_pages, F.lit("pages")).otherwise(F.lit("records")).alias("kind"),
        none.alias("first"),
        none.alias("last"),
        F.when(lacks_pages, F.col("pages") - F.col("seen")).otherwise(F.col("results") - F.col("records")).cast("long").alias("missing"),
        F.when(lacks_pages, F.concat(few(F.col("seen"), F.col("pages")), F.lit(" pages"))).otherwise(F.concat(few(F.col("records"), F.col("results")), F.lit(" records"))).alias("detail"),
    )
    return lost.unionByName(short).unionByName(unnumbered)


def read_documents(spark: SparkSession, path: str, record: StructType, multi_line: bool = False) -> DataFrame:
    """Bare records, or bare arrays of records, without an envelope."""
    return spark.read.schema(record).json(path, multiLine=multi_line)


def assessment_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_pages(spark, path, schemas.ASSESSMENT_HEADER)


def assessment_detail(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, schemas.ASSESSMENT_DETAIL)


def score_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_pages(spark, path, schemas.SCORE_RECORD)


def source_filters(
    df: DataFrame,
    date: Column,
    site: Column,
    site_ids: Sequence[int] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Optional site list and inclusive date range; plain comparisons, so parquet scans prune on them."""
    out = df.where(between_dates(date, start, end))
    return out.where(site.isin(list(site_ids))) if site_ids else out


def _leaves(schema: StructType, prefix: str = "") -> list[tuple[str, str]]:
    found = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, StructType):
            found += _leaves(f.dataType, path + ".")
        else:
            found.append((path, f.dataType.simpleString()))
    return found


def discover_schema(records: DataFrame) -> DataFrame:
    """Field, type and share of non-NULL values of records read without a schema; one pass."""
    leaves = _leaves(records.schema)
    counts = records.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(path)).alias(f"c{i}") for i, (path, _) in enumerate(leaves)],
    )
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(path).alias("field"),
                        F.lit(kind).alias("type"),
                        (F.col(f"c{i}") / F.nullif(F.col("n"), F.lit(0))).alias("non_null_rate"),
                    )
                    for i, (path, kind) in enumerate(leaves)
                ]
            )
        ).alias("f")
    ).select("f.*")


def discover_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``discover_schema`` of the records inside page envelopes."""
    pages = spark.read.json(path, multiLine=multi_line)
    return discover_schema(pages.select(F.explode("results").alias("r")).select("r.*"))


# --- schema sketch -----------------------------------------------------------------------------------

# Levels of objects and arrays that a sketch goes down.
MAX_DEPTH = 24


_NAMED = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}
_DIGITS = 38  # of a decimal


class _Number(str):
    """The type of a number, in its place."""

    def __new__(cls, text: str):
        whole, _, part = text.lstrip("-").partition(".")
        if whole == text.lstrip("-") and whole.isdigit() and len(whole) <= 19 and -(1 << 63) <= int(text) < 1 << 63:
            return str.__new__(cls, "bigint")
        exact = (whole + part).isdigit() and len((whole + part).lstrip("0")) <= _DIGITS and len(part) <= _DIGITS
        return str.__new__(cls, "decimal" if exact else "double")


class _Field:
    """Counts by type of one field, and the fields and elements in it."""

    __slots__ = ("name", "counts", "inner")

    def __init__(self, name: str):
        self.name, self.counts, self.inner = name, {}, {}

    def add(self, value, depth: int) -> None:
        kind = _NAMED.get(type(value), value)
        self.counts[kind] = self.counts.get(kind, 0) + 1
        if depth <= 1 or (kind != "object" and kind != "array"):
            return
        for key, inner in value.items() if kind == "object" else zip(repeat(None), value):
            field = self.inner.get(key)
            if field is None:
                top = "" if self.name == "$" else f"{self.name}."
                field = self.inner[key] = _Field(f"{self.name}[]" if key is None else top + key)
            field.add(inner, depth - 1)

    def rows(self) -> Iterator[tuple[str, str, int]]:
        for kind, n in self.counts.items():
            yield self.name, str(kind), n
        for field in self.inner.values():
            yield from field.rows()


def _counted_types(max_depth: int) -> Callable:
    """``file, field, type, n`` of each batch of documents; a missing one is unreadable."""
    names = ["file", "field", "type", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = json.JSONDecoder(parse_int=_Number, parse_float=_Number).raw_decode
        for batch in batches:
            files: dict[str, _Field] = {}
            rows = []
            for file, text in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if text is None:
                    rows.append((file, "$", "unreadable", 1))
                else:
                    document, _ = read(text.decode("utf-8", "replace").lstrip(" \t\r\n"))
                    files.setdefault(file, _Field("$")).add(document, max_depth)
            rows += [(file, *row) for file, top in files.items() for row in top.rows()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    return run


def schema_sketch(spark: SparkSession, path: str, multi_line: bool = False, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``file, field, type, n``: how many values of each type a field has in each file of JSON documents.

    A field in an object in an array is ``questions[].standards[].code``, an element ``questions[]``, the document itself ``$``. Types are
    ``object, array, string, boolean, bigint, decimal, double, null``, and ``unreadable`` for a document that cannot be parsed, as Spark's variants have them.
    Counts add up, so sketches of several folders merge by ``merge_sketches``. Documents are read without a schema and so
    without one type winning over another; each task goes once through its own and passes on the counts of each batch, not the values.
    """
    text = spark.read.text(path, wholetext=multi_line).select(F.col("_metadata.file_path").alias("file"), "value")
    readable = F.when(F.try_parse_json("value").isNotNull(), F.col("value").cast("binary"))
    documents = text.where(F.length(F.trim("value")) > 0).select("file", readable.alias("value"))
    return stage(merge_sketches(documents.mapInArrow(_counted_types(max_depth), "file string, field string, type string, n long")))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """Counts of all sketches added up."""
    return reduce(DataFrame.unionByName, sketches).groupBy("file", "field", "type").agg(F.sum("n").alias("n"))


def sketch_report(sketch: DataFrame) -> DataFrame:
    """``field, types, n, non_null_rate, files, clash, places``: a row a field.

    ``non_null_rate``: values that are not null for each object that could hold the field, or for each element. ``clash``: more than one
    type besides null; ``bigint``, ``decimal`` and ``double`` are one. ``places``: for each type how many files have it, and the first of them.
    """
    totals = sketch.groupBy("field", "type").agg(F.sum("n").alias("n"), F.countDistinct("file").alias("files"), F.min("file").alias("file"))
    numeric = F.col("type").isin("bigint", "decimal", "double")
    kinds = F.collect_set(F.when(numeric, F.lit("number")).when(F.col("type") != "null", F.col("type")))
    fields = totals.groupBy("field").agg(
        F.sort_array(F.collect_set(F.when(F.col("type") != "null", F.col("type")))).alias("types"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("type") != "null", F.col("n")).otherwise(0)).alias("filled"),
        (F.size(kinds) > 1).alias("clash"),
        F.sort_array(F.collect_list(F.struct("type", "n", "files", "file"))).alias("places"),
    )
    files = sketch.groupBy("field").agg(F.countDistinct("file").alias("files"))
    holder = F.when(F.col("field").contains("."), F.regexp_replace("field", r"\.[^.]*$", "")).when(F.col("field") != "$", F.lit("$"))
    objects = totals.where("type = 'object'").select(F.col("field").alias("holder"), F.col("n").alias("objects"))
    of = F.when(F.col("field").endswith("[]") | (F.col("field") == "$"), F.col("n")).otherwise(F.col("objects"))
    joined = fields.join(files, "field").withColumn("holder", holder).join(objects, "holder", "left")
    return joined.select("field", "types", "n", (F.col("filled") / of).alias("non_null_rate"), "files", "clash", "places")
