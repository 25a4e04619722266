"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that are spread at most; the table of them is the only thing that is broadcast.
MAX_HEAVY = 10_000
#: Items the counting sketch keeps. It finds every key that owns more than a few of so many parts of the rows.
SKETCH_ITEMS = 131_072
#: Kinds of join that stay right when a left row meets one copy of the right rows.
SPREADABLE = ("inner", "left", "left_semi", "left_anti")


def heavy_keys(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """(key hash, parts): keys with more rows than two even partitions hold, and the even partitions each would fill."""
    return _table(df.sparkSession, heavy_hashes(df, [keys], partitions)[0])


def heavy_hashes(df: DataFrame, keys: list[list[str]], partitions: int | None = None) -> list[list[tuple[int, int]]]:
    """The rows of ``heavy_keys`` for each of several keys, found in one pass over their columns.

    The sketches combine on the map side and have a fixed size, so nothing grows with the number of keys. One may take a
    light key for a heavy one, never the other way round beyond its error.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_hash{i}" for i in range(len(keys))]
    hashes = df.select(*[F.xxhash64(*k).alias(n) for n, k in zip(names, keys)])
    *found, total = hashes.agg(
        *[F.expr(f"approx_top_k({n}, {MAX_HEAVY}, {SKETCH_ITEMS})") for n in names], F.count(F.lit(1))
    ).first()
    even = max(total / partitions, 1)
    return [[(r["item"], -(-r["count"] // int(even))) for r in top or [] if r["count"] > 2 * even] for top in found]


def _table(spark: SparkSession, heavy: list[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame(heavy, "_hash long, _parts long")


@dataclass(frozen=True)
class Spread:
    """Rows dealt by a key, those of its heavy values to several parts; the lookup rows of these are copied to each part.

    ``keys`` are what dealt rows and copied lookups are joined by; without heavy values that is the key and nothing changes.
    """

    key: list[str]
    heavy: list[tuple[int, int]]
    names: tuple[str, str, str] = ("_hash", "_parts", "_part")

    @property
    def keys(self) -> list[str]:
        return [*self.key, self.names[2]] if self.heavy else self.key

    def _marked(self, df: DataFrame) -> DataFrame:
        hash_, parts, _ = self.names
        heavy = F.broadcast(_table(df.sparkSession, self.heavy).toDF(hash_, parts))
        return df.withColumn(hash_, F.xxhash64(*self.key)).join(heavy, hash_, "left")

    def _with_part(self, df: DataFrame, part: Column) -> DataFrame:
        hash_, parts, name = self.names
        return df.withColumn(name, part).drop(hash_, parts)

    def dealt(self, df: DataFrame, by: list[str]) -> DataFrame:
        """Rows with their part, which follows from the columns ``by``."""
        if not self.heavy:
            return df
        return self._with_part(self._marked(df), F.coalesce(F.pmod(F.xxhash64(*[f"`{c}`" for c in by]), self.names[1]), F.lit(0)))

    def copied(self, df: DataFrame) -> DataFrame:
        """Rows once for each part of their key."""
        if not self.heavy:
            return df
        last = F.coalesce(self.names[1], F.lit(1)) - 1
        return self._with_part(self._marked(df), F.explode(F.sequence(F.lit(0).cast("long"), last)))


def would_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's estimate of ``df`` is within its limit for a broadcast."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    partitions: int | None = None,
    heavy: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)``, the same rows and columns, with the left rows of heavy keys spread.

    AQE splits a hot key only where both sides come straight from an exchange; it cannot where one side was aggregated by
    the key or is partitioned by it already. Here a heavy key of the left side is dealt to as many parts as it fills
    even partitions, and the right rows of that key, and of no other, are copied to each part. NULL keys match nothing
    and are spread like any other. A part follows from the row's own columns, so a task that runs again deals alike.

    The right side should hold few rows of a key (a lookup, a total). Where it is small enough to be broadcast there is
    nothing to spread and no sketch is taken; otherwise the sketch is a job of its own, run when the plan is built, unless the
    heavy keys are given.
    """
    if how not in SPREADABLE:
        raise ValueError(f"{how} join cannot be spread: use one of {', '.join(SPREADABLE)}")
    if partitions is None and would_broadcast(right):
        return left.join(right, keys, how)
    if heavy is None:
        heavy = heavy_hashes(left, [keys], partitions)[0]
    taken = {c.lower() for c in (*left.columns, *right.columns)}
    spread = Spread(keys, heavy, tuple(_free(name, taken) for name in ("_hash", "_parts", "_part")))
    return spread.dealt(left, left.columns).join(spread.copied(right), spread.keys, how).drop(spread.names[2])


def join_beside(left: DataFrame, right: DataFrame, keys: list[str], beside: list[str]) -> DataFrame:
    """``left.join(right, [*keys, *beside], "left")``, with the columns ``beside`` compared as a condition.

    Rows that were dealt by ``keys`` stay where they are: the planner takes their place for that of a join only if they were
    dealt by all its keys, and a column that is the same constant everywhere, as a company may be, is none to it.
    """
    names = {c: f"_of_{c}" for c in (*keys, *beside)}
    test = F.lit(True)
    for c, own in names.items():
        test &= F.col(c) == F.col(own) if c in keys else (F.col(c) <= F.col(own)) & (F.col(c) >= F.col(own))
    return left.join(right.withColumnsRenamed(names), test, "left").drop(*names.values())


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name
