"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.llm.staging import staged

#: Bytes looked at on the first level; every further level looks at `GROWTH` times as many.
FIRST_WIDTH = 64
GROWTH = 16


def ascii_lower(text: Column) -> Column:
    """Text with A-Z lower-cased and all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    first_width: int = FIRST_WIDTH,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and `row`, the whole input row, if asked).

    Most significant digits first: on each level the rows of a group are split by their next bytes. A group that is
    left with one row, or whose rows have ended, is done; only the others go on to the next bytes.
    Groups are equal byte by byte, so no digest decides; `text_sha256` is only reported. A level counts its groups
    with map-side combining and then joins rows with their group's one line, so a group that holds a third of all
    rows arrives as one line per task in the count and is split by the skew join afterwards.

    Of equal texts the row with the largest id stays. Null ids are smaller than any other; rows that repeat id and
    text are told apart by their place in the input, and one of them stays. The input has to give the same rows in
    the same places when it is read again, as files do.
    """
    columns = df.columns if carry else [text_col]
    open_rows = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.lit(0).cast("long").alias("grp"),
        F.sha2(ascii_lower(F.col(f"`{text_col}`")).cast("binary"), 256).alias("text_sha256"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
    )
    kept_columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *(["row"] if carry else [])]
    done, offset, width = [], 0, first_width
    while True:
        body = ascii_lower(F.col("row")[text_col]).cast("binary")
        keyed = open_rows.withColumn("head", F.substring(body, offset + 1, width))
        groups = keyed.groupBy("grp", "head").agg(
            F.count("*").alias("group_size"), F.max(F.struct("doc_id", "place")).alias("top")
        )
        unfinished = (F.col("group_size") > 1) & (F.length("head") == width)
        level = keyed.join(groups, ["grp", "head"]).select(
            "doc_id",
            "place",
            F.col("top.place").alias("grp"),
            "text_sha256",
            unfinished.alias("open"),
            (F.col("row") if carry else F.when(unfinished, F.col("row"))).alias("row"),
            F.col("top.doc_id").alias("keep_id"),
            "group_size",
            (F.col("place") == F.col("top.place")).alias("kept"),
        )
        level = staged(level, "radix")
        done.append(level.filter(~F.col("open")).select(*kept_columns))
        open_rows = level.filter("open").drop("open", "keep_id", "group_size", "kept")
        if open_rows.isEmpty():
            return reduce(DataFrame.unionByName, done)
        offset += width
        width *= growth
