"""What is kept of partitioned tables: a few rows per month or year, so that queries over all history need not read it.

A rollup remembers which load of its source each partition came from. Whatever replaces or drops partitions of the source
(a night, a backfill, retention) shows in the source's pointer, so only the periods with a changed partition are summed up
again, and a reader gets those straight from the source until that has been done: answers are exact at any time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_invoice, is_receipt, not_cancelled
from ..model import BALANCES, LAST_PURCHASES, LAST_SALES, PURCHASES, SALES, YEAR_BALANCES, TableSpec
from .live import Live, Pointers


@dataclass(frozen=True)
class Rollup:
    """``summary`` makes rows of ``spec`` out of source rows; it groups by the period, ``spec.partition_by``, among others."""

    spec: TableSpec
    source: TableSpec
    summary: Callable[[DataFrame], DataFrame]
    by_year: bool = False

    def period(self, partition: str) -> str:
        """First day of the month or year of a partition of the source."""
        return f"{partition[:4]}-01-01" if self.by_year else f"{partition[:7]}-01"

    def _period(self) -> Column:
        return F.trunc(F.col(self.source.partition_by), "YEAR" if self.by_year else "MM")

    def _state(self, store) -> tuple[Live, Live, set[str]]:
        """Source, rollup, and the periods in which they differ."""
        source, kept = store.live(self.source), store.live(self.spec)
        both = source.folders.keys() | kept.built_from.keys()
        changed = {v for v in both if source.folders.get(v) != kept.built_from.get(v)}
        return source, kept, {self.period(v) for v in changed}

    def _summed(self, store, source: Live, periods: set[str]) -> DataFrame:
        days = [v for v in source.folders if self.period(v) in periods]
        rows = self.summary(store.read_partitions(self.source, days, source).withColumn(self.spec.partition_by, self._period()))
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema])

    def refresh(self, store) -> list[str]:
        """Sum up again the periods that have changed; returns them."""
        source, kept, stale = self._state(store)
        if stale:
            rows = self._summed(store, source, stale)
            store.commit_rollup(self.spec, Pointers(store.files, self.spec.name), kept, rows, sorted(stale), source.folders)
        return sorted(stale)

    def read(self, store) -> DataFrame:
        """Kept rows, and the periods that have changed since, summed up from the source."""
        source, kept, stale = self._state(store)
        rows = store.read_partitions(self.spec, [v for v in kept.folders if v not in stale], kept)
        return rows.unionByName(self._summed(store, source, stale)) if stale else rows


def _last_sales(rows: DataFrame) -> DataFrame:
    return rows.filter(is_invoice()).groupBy("MES", "EMPRESA", "ARTICULO_ID", "ALMACEN_ID").agg(F.max("FECHA").alias("ULTIMA_VENTA"))


def _last_purchases(rows: DataFrame) -> DataFrame:
    received = rows.filter(is_receipt() & not_cancelled())
    return received.groupBy("MES", "EMPRESA", "ARTICULO_ID").agg(F.max("FECHA").alias("ULTIMA_COMPRA"))


def _net_of_year(rows: DataFrame) -> DataFrame:
    net = lambda what: F.sum(F.coalesce(f"ENTRADAS_{what}", F.lit(0)) - F.coalesce(f"SALIDAS_{what}", F.lit(0)))
    return rows.groupBy("DESDE", "EMPRESA", "ARTICULO_ID", "ALMACEN_ID").agg(net("UNIDADES").alias("UNIDADES"), net("COSTO").alias("COSTO"))


ROLLUPS = {
    r.spec.name: r
    for r in (
        Rollup(LAST_SALES, SALES, _last_sales),
        Rollup(LAST_PURCHASES, PURCHASES, _last_purchases),
        Rollup(YEAR_BALANCES, BALANCES, _net_of_year, by_year=True),
    )
}
