"""Aggregations that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Distinct:
    """Distinct, non-NULL values of ``column``; one count per condition."""

    column: str
    counts: dict[str, Column | None] = field(default_factory=dict)


def summarise(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column] | None = None,
    mins: dict[str, Column] | None = None,
    maxs: dict[str, Column] | None = None,
    bits: dict[str, Column] | None = None,
    distinct: list[Distinct] = (),
    fine_keys: bool = False,
) -> DataFrame:
    """Group by ``keys`` with sums, extremes and (conditional) distinct counts.

    Two steps. The first groups by the keys *and* each counted column, so a hot key is
    spread over its documents or items and every task combines before the shuffle; the
    second adds up what is left. Conditions on the same column share one pass, where
    ``count(distinct when(..))`` would copy every row once per condition. ``bits`` are or-ed,
    which counts distinct values of a small range without a pass of its own.

    ``fine_keys`` says that a group holds few documents (a day, item and warehouse, say), so
    nothing would combine before the shuffle and no group is hot: rows are then dealt by the
    keys once, and both steps use that.
    """
    sums, mins, maxs, bits = sums or {}, mins or {}, maxs or {}, bits or {}
    folds = [(n, F.sum, e) for n, e in sums.items()]
    folds += [(n, F.min, e) for n, e in mins.items()]
    folds += [(n, F.max, e) for n, e in maxs.items()]
    folds += [(n, F.bit_or, e) for n, e in bits.items()]
    if not distinct:
        return df.groupBy(*keys).agg(*[fold(e).alias(n) for n, fold, e in folds])

    flags = {
        name: F.max(F.when(test, 1).otherwise(0)) if test is not None else F.lit(1)
        for d in distinct
        for name, test in d.counts.items()
    }
    ids = [d.column for d in distinct]
    first = [fold(e).alias(n) for n, fold, e in folds] + [f.alias(n) for n, f in flags.items()]
    if len(ids) == 1:
        if fine_keys:
            df = df.repartition(*keys)
        parts = df.groupBy(*keys, *ids).agg(*first)
        in_set = {ids[0]: F.lit(True)}
    else:
        marks = [F.grouping(i).alias(f"_not_{i}") for i in ids]
        parts = df.groupingSets([[*keys, i] for i in ids], *keys, *ids).agg(*first, *marks)
        in_set = {i: F.col(f"_not_{i}") == 0 for i in ids}

    def once(c: Column) -> Column:
        # The plain measures are present in every grouping set; take them from the first.
        return c if len(ids) == 1 else F.when(in_set[ids[0]], c)

    out = [fold(once(F.col(n))).alias(n) for n, fold, _ in folds]
    for d in distinct:
        counted = in_set[d.column] & F.col(d.column).isNotNull()
        for name in d.counts:
            out.append(F.sum(F.when(counted, F.col(name)).otherwise(0)).cast("bigint").alias(name))
    return parts.groupBy(*keys).agg(*out)


def pick_first(df: DataFrame, keys: list[str], order: list[str], carry: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per key (NULLs first), ties broken by ``carry``.

    ``min`` of a struct combines before the shuffle: one row per key and task travels,
    where a row-number window would bring every row of a hot key into one task.
    """
    return _pick(df, keys, order, carry, F.min)


def pick_last(df: DataFrame, keys: list[str], order: list[str], carry: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key (NULLs last), ties broken by ``carry``."""
    return _pick(df, keys, order, carry, F.max)


def _pick(df: DataFrame, keys: list[str], order: list[str], carry: list[str], fold) -> DataFrame:
    extra = [c for c in carry if c not in order]
    return df.groupBy(*keys).agg(fold(F.struct(*order, *extra)).alias("_p")).select(
        *keys, *[F.col(f"_p.{c}").alias(c) for c in carry]
    )
