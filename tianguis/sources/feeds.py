"""What the loader adds to a feed before typing it."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sales document feeds and the type each stands for.
SALES_FEEDS = {"facturas": "F", "remisiones": "R", "pedidos": "P", "cotizaciones": "C", "devoluciones": "D"}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """``{type: feed}`` -> one table. A feed that brings TIPO_DOCTO keeps it, NULLs included."""
    tagged = [
        df if "TIPO_DOCTO" in df.columns else df.withColumn("TIPO_DOCTO", F.lit(tipo)) for tipo, df in feeds.items()
    ]
    return union_all(tagged)


def month_delta(rows: DataFrame, first: date) -> DataFrame:
    """The movements of one month."""
    return rows.withColumns({"PERIODO": F.lit(first.replace(day=1)), "ES_SALDO_INICIAL": F.lit(False)})


def opening_balance(cumulative: DataFrame, first: date) -> DataFrame:
    """The balance up to and including a month, booked as that month's receipts."""
    month = F.lit(first.replace(day=1))
    return cumulative.select(
        month.alias("PERIODO"),
        F.year(month).cast("bigint").alias("ANO"),
        F.month(month).cast("bigint").alias("MES"),
        F.dayofmonth(F.last_day(month)).cast("bigint").alias("ULTIMO_DIA"),
        "ARTICULO_ID",
        "ALMACEN_ID",
        F.col("EXISTENCIA").alias("ENTRADAS_UNIDADES"),
        F.lit(0).alias("SALIDAS_UNIDADES"),
        F.col("COSTO").alias("ENTRADAS_COSTO"),
        F.lit(0).alias("SALIDAS_COSTO"),
        F.lit(True).alias("ES_SALDO_INICIAL"),
    )


def snapshot_of(rows: DataFrame, taken_on: date) -> DataFrame:
    """Stock as of the run date."""
    return rows.withColumn("_snapshot_date", F.lit(taken_on))
