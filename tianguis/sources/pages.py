"""Landed API pages, one per line.

A page is ``{"data": [...], "has_more": .., "next_cursor": .., "answer": .., "cursor": ..}``. The first three are the
source's; ``cursor`` is what the page was asked with (the first page of an answer: 0 or absent) and ``answer`` names the
answer it belongs to. A page that is a whole answer by itself needs neither.

A page that does not parse, or an answer of which a page is missing, fails the load: read as "no rows" it would empty what
the load replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .typing import fail_when

HEADER = "has_more BOOLEAN, next_cursor BIGINT, answer STRING, cursor BIGINT"
HEADER_NAMES = ("has_more", "next_cursor", "answer", "cursor")


class InferredTypes(RuntimeError):
    """A catalog column has changed to a type that does not go with the one before."""


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns as text: numbers keep every digit they were sent with."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def page_schema(row: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("data", T.ArrayType(row)), *T.StructType.fromDDL(HEADER).fields])


def strict(spark: SparkSession):
    """A JSON reader to which a line that is not whole JSON is an error."""
    return spark.read.option("mode", "FAILFAST")


def _folder_columns(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in ("data", *HEADER_NAMES)]


def chain_faults(headers: DataFrame) -> DataFrame:
    """The pages after which an answer does not go on as it should, with a ``fault`` each.

    Cursors go up along an answer, so in their order the first page was asked with 0, each page that announces more is
    followed by the one its ``next_cursor`` asks for, and the page that announces none is the last. Two pages with one
    cursor, a gap, a second end and a page that nothing asks for all break this. A page without an answer's name that is
    first and last is an answer by itself; others without a name belong to one answer of their folder.
    """
    cursor, more = F.coalesce("cursor", F.lit(0)), F.coalesce("has_more", F.lit(False))
    where = _folder_columns(headers)
    pages = headers.select(*where, "answer", cursor.alias("cursor"), more.alias("has_more"), "next_cursor")
    pages = pages.filter(F.col("answer").isNotNull() | F.col("has_more") | (F.col("cursor") != 0))
    of_answer = Window.partitionBy(*where, "answer").orderBy("cursor", "has_more", "next_cursor")
    after = F.lead("cursor").over(of_answer)
    page = F.concat(F.lit("the page asked with cursor "), F.col("cursor"))
    announced, stalls = F.col("next_cursor"), F.coalesce(F.col("next_cursor") <= F.col("cursor"), F.lit(True))
    fault = (
        F.when((F.row_number().over(of_answer) == 1) & (F.col("cursor") != 0), F.concat(F.lit("the first page is missing before "), page))
        .when(F.col("has_more") & stalls, F.concat(page, F.lit(" announces more but no later cursor")))
        .when(F.col("has_more") & after.isNull(), F.concat(F.lit("the last page of a paged answer is missing: cursor "), announced))
        .when(F.col("has_more") & (after != announced), F.concat(page, F.lit(" announces cursor "), announced, F.lit(", the next page was asked with "), after))
        .when(~F.col("has_more") & after.isNotNull(), F.concat(page, F.lit(" ends the answer, but there is one with cursor "), after))
    )
    return pages.withColumn("fault", fault).filter("fault IS NOT NULL")


def complete(pages: DataFrame, headers: DataFrame, table: str) -> DataFrame:
    """The same pages; the job fails if the headers show an answer that is not whole.

    Headers are read once, without the data; only those of paged answers are compared, and none of them meets another
    answer's.
    """
    named = F.concat(F.coalesce(F.concat(F.lit("answer "), "answer", F.lit(": ")), F.lit("")), "fault")
    fault = chain_faults(headers).agg(F.min(named)).scalar()  # named twice here, run once
    broken = F.raise_error(F.concat(F.lit(f"{table}: "), fault)).cast("boolean")
    return pages.filter(F.when(fault.isNotNull(), broken).otherwise(F.lit(True)))


def page_rows(pages: DataFrame, headers: DataFrame, whole_chunk: bool, table: str = "") -> DataFrame:
    """All rows of all pages. A page without ``data`` is empty.

    A source that answers in one page must not announce more: that answer was cut off, so the job fails. The test travels
    with the rows.
    """
    return checked(pages, headers, whole_chunk, table).select(*_folder_columns(pages), F.inline("data"))


def checked(pages: DataFrame, headers: DataFrame, whole_chunk: bool, table: str) -> DataFrame:
    if whole_chunk:
        return fail_when(pages, F.coalesce("has_more", F.lit(False)), f"{table}: truncated chunk (has_more is true)")
    return complete(pages, headers, table)


def _landed(spark: SparkSession, path: str, row: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Pages with their data, and their headers alone."""
    return strict(spark).schema(page_schema(row)).json(path), strict(spark).schema(HEADER).json(path)


def read_pages(spark: SparkSession, path: str, schema: T.StructType, whole_chunk: bool = False, table: str = "") -> DataFrame:
    """Typed tables: every column as text, to be cast by ``type_rows``."""
    return page_rows(*_landed(spark, path, text_schema(schema)), whole_chunk, table)


def read_pages_with_defaults(
    spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, str], table: str = ""
) -> DataFrame:
    """S5 from files: like ``read_pages``; a row that lacks a key of ``defaults`` gets its value.

    Rows are read as maps here, because an absent key and an explicit null differ.
    """
    pages, headers = _landed(spark, path, T.MapType(T.StringType(), T.StringType()))
    extra = _folder_columns(pages)

    def value(row: Column, name: str) -> Column:
        found = row[name.upper()]
        if name in defaults:
            found = F.when(F.map_contains_key(row, name.upper()), found).otherwise(F.lit(defaults[name]))
        return found.alias(name)

    # Names in upper case, as typed rows find their columns whatever the case. Both steps are inside the generator: outside of
    # it, every filter and cast that names a column would turn the whole row's names again.
    upper = F.transform("data", lambda row: F.transform_keys(row, lambda name, value: F.upper(name)))
    rows = F.transform(upper, lambda row: F.struct(*[value(row, n) for n in schema.names]))
    return complete(pages, headers, table).select(*extra, F.inline(rows))


# --- S9 ---

#: Numbers with a fraction, of whatever digits, so that a catalog's type does not follow each night's values.
NUMBER = T.DecimalType(38, 9)


def _kind(found: T.DataType) -> T.DataType:
    return NUMBER if isinstance(found, (T.FractionalType, T.DecimalType)) else found


def wider(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds values of both: whole number, then number, then text. None if there is none."""
    order = [T.LongType(), NUMBER, T.StringType()]
    if old == new:
        return old
    return max(old, new, key=order.index) if old in order and new in order else None


def inferred_schema(pages: DataFrame, typed: DataFrame, before: T.StructType | None, table: str) -> T.StructType:
    """Types of the rows of ``pages``, reconciled with those of the night before.

    ``typed`` are the same pages read without the columns that hold only nulls: such a column keeps the type it had, or is
    text. Other columns widen, whole number to number to text, and never go back; any other change is refused. Columns that
    the source no longer sends are gone.
    """
    row = lambda df: df.schema["data"].dataType.elementType if _has_rows(df) else T.StructType([])
    held = {f.name.upper(): _kind(f.dataType) for f in row(typed)}
    had = {f.name.upper(): f.dataType for f in before or []}
    fields = []
    for f in row(pages):
        name = f.name.upper()
        kind = held.get(name) or had.get(name, T.StringType())
        if name in held and name in had:
            kind = wider(had[name], held[name])
            if kind is None:
                raise InferredTypes(f"{table}: {f.name} was {had[name].simpleString()} and is {held[name].simpleString()} now")
        fields.append(T.StructField(f.name, kind))
    return T.StructType(fields)


def _has_rows(pages: DataFrame) -> bool:
    """Whether some page holds a row: ``data`` that is absent, null or empty everywhere tells nothing of its rows."""
    kind = pages.schema["data"].dataType if "data" in pages.columns else None
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def read_inferred_pages(
    spark: SparkSession, path: str, whole_chunk: bool = True, table: str = "", before: T.StructType | None = None
) -> DataFrame:
    """Catalogs whose columns are not fixed; their types are inferred over all rows and go with those of ``before``."""
    reader = lambda: strict(spark).option("prefersDecimal", True)
    seen = reader().json(path)
    if not _has_rows(seen):
        return spark.createDataFrame([], before or T.StructType([]))  # only empty pages: nothing to infer from
    schema = inferred_schema(seen, reader().option("dropFieldIfAllNull", True).json(path), before, table)
    return page_rows(*_landed(spark, path, schema), whole_chunk, table)
