"""Text rows -> typed rows with metadata columns."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import blank_to_null, utc


def fail_when(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """The same rows; the job fails, before anything is committed, if one of them is bad."""
    return df.filter(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def typed(c: Column, to: T.DataType) -> Column:
    """Trimmed text, empty as NULL, cast exactly; a value that does not fit raises."""
    value = blank_to_null(c)
    if isinstance(to, T.DateType):
        value = F.substring(value, 1, 10)
    elif isinstance(to, T.TimestampNTZType):
        value = F.translate(value, "T", " ")
    return value.cast(to)


def type_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns. Others are dropped, absent ones are NULL."""
    present = {c.upper(): c for c in rows.columns}
    out = []
    for f in schema:
        if f.name.upper() not in present:
            c = F.lit(None).cast(f.dataType)
        else:
            source = rows.schema[present[f.name.upper()]].dataType
            c = F.col(present[f.name.upper()])
            # Columns set by the pipeline itself (dates, flags) are typed already.
            c = typed(c, f.dataType) if isinstance(source, T.StringType) else c.cast(f.dataType)
        out.append(c.alias(f.name))
    return rows.select(*out)


def with_meta(rows: DataFrame, empresa: str, synced_at: datetime) -> DataFrame:
    """S3: company and one load time for the whole batch, given by the caller."""
    return rows.withColumns({"EMPRESA": F.lit(empresa), "_synced_at": utc(synced_at)})


def require(rows: DataFrame, names: list[str], table: str = "") -> DataFrame:
    """A NULL in a required column fails the load."""
    if not names:
        return rows
    missing = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    return fail_when(rows, missing, f"{table}: NULL in a required column ({', '.join(names)})")


def finalise(rows: DataFrame, schema: T.StructType | None, empresa: str, synced_at: datetime, table: str = "") -> DataFrame:
    """Metadata, then types and required columns where the table has a fixed schema."""
    rows = with_meta(rows, empresa, synced_at)
    if schema is None:
        return rows
    return require(type_rows(rows, schema), [f.name for f in schema if not f.nullable], table)
