"""The figures the dashboards show on top of the views."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day, is_invoice, is_receipt, is_return, month, not_cancelled, only, ratio, signed
from ..model import Tables
from ..operators.aggregates import Distinct, summarise
from .dims import CUSTOMER, ITEM, sellers, with_items
from .inventory import fill_months, idle, stock_and_movements, stock_changes, until_next
from .sales import recency_segment



def _net():
    return F.col("IMPORTE_NETO")


def _profit():
    return F.col("UTILIDAD")


def sales_scorecard(t: Tables, start: date, end: date) -> DataFrame:
    """Net, profit, margin and distinct invoices per company in a date range."""
    rows = t["fact_ventas_articulo"].filter(F.col("FECHA").between(day(start), day(end)))
    return summarise(
        rows, ["EMPRESA"], sums={"IMPORTE_NETO": _net(), "UTILIDAD": _profit()},
        distinct=[Distinct("DOCTO_VE_ID", {"FACTURAS": is_invoice()})],
    ).select("EMPRESA", "IMPORTE_NETO", "UTILIDAD", ratio(_profit(), _net()).alias("MARGEN_PCT"), "FACTURAS")


def monthly_sales(t: Tables) -> DataFrame:
    """Net against profit by month."""
    rows = t["fact_ventas_articulo"].withColumn("MES", month(F.col("FECHA")))
    return summarise(rows, ["EMPRESA", "MES"], sums={"IMPORTE_NETO": _net(), "UTILIDAD": _profit()})


def top_items(t: Tables, k: int) -> DataFrame:
    """The ``k`` items with the highest net sales."""
    sold = summarise(
        t["fact_ventas_articulo"], ITEM,
        sums={"IMPORTE_NETO": _net(), "UTILIDAD": _profit(), "UNIDADES_DEVUELTAS": only(is_return(), -F.col("UNIDADES"))},
    )
    best = sold.orderBy(_net().desc(), "EMPRESA", "ARTICULO_ID").limit(k)
    return with_items(best, t).select(
        "EMPRESA", "ARTICULO_ID", "ARTICULO", "LINEA", "IMPORTE_NETO", ratio(_profit(), _net()).alias("MARGEN_PCT"),
        "UNIDADES_DEVUELTAS",
    )


def month_over_month(t: Tables) -> DataFrame:
    """D3: each month against the calendar month before it, NULL if that had no sales; the window holds one row per month."""
    last = Window.partitionBy("EMPRESA").orderBy("MES")
    follows = F.lag("MES").over(last) == F.add_months("MES", -1)
    before = F.when(follows, F.lag("IMPORTE_NETO").over(last))
    rows = monthly_sales(t).select("EMPRESA", "MES", "IMPORTE_NETO", before.alias("IMPORTE_ANTERIOR"))
    return rows.withColumn("CAMBIO_PCT", ratio(_net() - F.col("IMPORTE_ANTERIOR"), F.col("IMPORTE_ANTERIOR")))


def period_over_period(t: Tables, start: date, end: date) -> DataFrame:
    """D3: net sales of [start, end] per company against the range of as many days just before it."""
    before = start - (end - start) - timedelta(days=1)
    inside = F.col("FECHA") >= day(start)
    sold = t["fact_ventas_articulo"].filter(F.col("FECHA").between(day(before), day(end))).groupBy("EMPRESA").agg(
        F.sum(F.when(inside, _net())).alias("IMPORTE_NETO"), F.sum(F.when(~inside, _net())).alias("IMPORTE_ANTERIOR")
    )
    return sold.withColumn("CAMBIO_PCT", ratio(_net() - F.col("IMPORTE_ANTERIOR"), F.col("IMPORTE_ANTERIOR")))


def customers_by_segment(t: Tables, as_of: date) -> DataFrame:
    """Number of customers per recency segment, from the last invoice date alone."""
    last = t["fact_ventas_articulo"].filter(is_invoice()).groupBy(*CUSTOMER).agg(F.max("FECHA").alias("ULTIMA_COMPRA"))
    customers = t["dim_clientes"].select(*CUSTOMER).join(last, CUSTOMER, "left")
    return customers.groupBy("EMPRESA", recency_segment(as_of).alias("SEGMENTO_RECENCIA")).agg(F.count(F.lit(1)).alias("CLIENTES"))


def seller_months(t: Tables) -> DataFrame:
    """Monthly net sales by seller."""
    rows = t["fact_ventas_articulo"].withColumn("MES", month(F.col("FECHA")))
    sold = summarise(rows, ["EMPRESA", "MES", "VENDEDOR_ID"], sums={"IMPORTE_NETO": _net(), "UTILIDAD": _profit()})
    return sold.join(sellers(t), ["EMPRESA", "VENDEDOR_ID"], "left").select(
        "EMPRESA", "MES", "VENDEDOR_ID", "VENDEDOR", "IMPORTE_NETO", "UTILIDAD"
    )


def inventory_scorecard(t: Tables, as_of: date) -> DataFrame:
    """Stock value, items with stock, idle rows (never sold or not in 180 days)."""
    rows = stock_and_movements(t, as_of).withColumns({"CON_STOCK": F.col("EXISTENCIA") > 0, "PARADO": idle()})
    return summarise(
        rows, ["EMPRESA"], sums={"VALOR_COSTO": F.col("COSTO"), "SIN_MOVIMIENTO": only(F.col("PARADO"), F.lit(1))},
        distinct=[Distinct("ARTICULO_ID", {"ARTICULOS_CON_EXISTENCIA": F.col("CON_STOCK")})],
    )


def inventory_by_line(t: Tables, as_of: date) -> DataFrame:
    """Month-end stock and units sold by product line and month.

    Closing balances add up, so movements are summed by line first and the running sum and
    the missing months are worked out per line, not per item and warehouse.
    """
    keys = ["EMPRESA", "LINEA_ARTICULO_ID", "LINEA"]
    moved = with_items(stock_changes(t, as_of), t).groupBy(*keys, "PERIODO").agg(
        F.sum(F.col("ENTRADAS_UNIDADES") - F.col("SALIDAS_UNIDADES")).alias("NETO"),
        F.sum("UNIDADES_VENDIDAS").alias("UNIDADES_VENDIDAS"),
    )
    series = Window.partitionBy(*keys).orderBy("PERIODO")
    changes = moved.withColumns(
        {"EXISTENCIA_FIN_MES": F.sum("NETO").over(series), "HASTA": until_next(series, F.trunc(day(as_of), "MM"))}
    )
    return fill_months(changes, {"UNIDADES_VENDIDAS": F.lit(0)}).select(
        "EMPRESA", "PERIODO", "LINEA_ARTICULO_ID", "LINEA", "EXISTENCIA_FIN_MES", "UNIDADES_VENDIDAS"
    )


def sell_in_against_sell_out(t: Tables) -> DataFrame:
    """Units and amounts bought and sold per item and month; either side may be missing.

    Both sides are added up by union and one aggregation, which is the full outer join on
    unique keys without shuffling twice.
    """
    bought = t["fact_compras_partidas"].filter(not_cancelled()).select(
        *ITEM, month(F.col("FECHA")).alias("MES"),
        signed(is_receipt(), F.col("UNIDADES")).alias("UNIDADES_COMPRADAS"),
        signed(is_receipt(), F.col("PRECIO_TOTAL_NETO")).alias("IMPORTE_COMPRADO"),
    )
    sold = t["fact_ventas_articulo"].select(
        *ITEM, month(F.col("FECHA")).alias("MES"),
        F.col("UNIDADES").alias("UNIDADES_VENDIDAS"), _net().alias("IMPORTE_VENDIDO"),
    )
    measures = ["UNIDADES_COMPRADAS", "IMPORTE_COMPRADO", "UNIDADES_VENDIDAS", "IMPORTE_VENDIDO"]
    both = bought.unionByName(sold, allowMissingColumns=True)
    return both.groupBy(*ITEM, "MES").agg(*[F.sum(m).alias(m) for m in measures])


def return_rates(t: Tables) -> DataFrame:
    """Returned against invoiced units per item and customer."""
    sold = summarise(
        t["fact_ventas_articulo"], [*ITEM, "CLIENTE_ID"],
        sums={
            "UNIDADES_FACTURADAS": only(is_invoice(), F.col("UNIDADES")),
            "UNIDADES_DEVUELTAS": only(is_return(), -F.col("UNIDADES")),
        },
    )
    return sold.withColumn("TASA_DEVOLUCION", ratio(F.col("UNIDADES_DEVUELTAS"), F.col("UNIDADES_FACTURADAS")))
