"""Sales by item and day, by customer and month, customer summary, margin by line."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day, days_between, is_invoice, is_return, month, months_back, only, ratio
from ..model import Tables
from ..operators.aggregates import Distinct, summarise
from ..operators.joins import spread_join
from .catalog import DEFAULT_CHANNEL, customer_type_channels
from .dims import CUSTOMER, ITEM, lines, sellers, with_item_and_warehouse

AMOUNTS = ("IMPORTE_NETO", "COSTO", "UTILIDAD")


def _sums(*names: str):
    return {n: F.col(n) for n in names}


def daily_item_sales(t: Tables) -> DataFrame:
    """Net sales per company, day, item and warehouse."""
    sold = summarise(
        t["fact_ventas_articulo"],
        ["EMPRESA", "FECHA", "ARTICULO_ID", "ALMACEN_ID"],
        sums={**_sums("UNIDADES", *AMOUNTS), "UNIDADES_DEVUELTAS": only(is_return(), -F.col("UNIDADES"))},
        distinct=[Distinct("DOCTO_VE_ID", {"FACTURAS": is_invoice(), "DEVOLUCIONES": is_return()})],
        fine_keys=True,
    )
    return with_item_and_warehouse(sold, t).select(
        "EMPRESA", "FECHA", month(F.col("FECHA")).alias("MES"),
        "ARTICULO_ID", "ARTICULO", "ARTICULO_ESTATUS", "LINEA_ARTICULO_ID", "LINEA", "GRUPO_LINEA_ID",
        "ALMACEN_ID", "ALMACEN", "UNIDADES", *AMOUNTS,
        ratio(F.col("UTILIDAD"), F.col("IMPORTE_NETO")).alias("MARGEN_PCT"),
        "FACTURAS", "DEVOLUCIONES", "UNIDADES_DEVUELTAS",
    )


def customer_month_sales(t: Tables) -> DataFrame:
    """Net sales per company, month, customer and seller, with zone and channel."""
    sold = summarise(
        t["fact_ventas_articulo"].withColumn("MES", month(F.col("FECHA"))),
        ["EMPRESA", "MES", "CLIENTE_ID", "VENDEDOR_ID"],
        sums={**_sums(*AMOUNTS), "FACTURADO": only(is_invoice(), F.col("IMPORTE_NETO"))},
        distinct=[
            Distinct("DOCTO_VE_ID", {"FACTURAS": is_invoice(), "DEVOLUCIONES": is_return()}),
            Distinct("ARTICULO_ID", {"ARTICULOS_DISTINTOS": None}),
        ],
    )
    channels = customer_type_channels(t, with_company=True).select("EMPRESA", "TIPO_CLIENTE_ID", "ZONA", "FORMATO")
    customers = (
        t["dim_clientes"]
        .select(*CUSTOMER, F.col("NOMBRE").alias("CLIENTE"), F.col("ESTATUS").alias("CLIENTE_ESTATUS"), "TIPO_CLIENTE_ID")
        .join(channels, ["EMPRESA", "TIPO_CLIENTE_ID"], "left")
    )
    return (
        sold.join(customers, CUSTOMER, "left")
        .join(sellers(t), ["EMPRESA", "VENDEDOR_ID"], "left")
        .select(
            "EMPRESA", "MES", "CLIENTE_ID", "CLIENTE", "CLIENTE_ESTATUS", "TIPO_CLIENTE_ID", "ZONA",
            F.coalesce("FORMATO", F.lit(DEFAULT_CHANNEL)).alias("FORMATO"),
            "VENDEDOR_ID", "VENDEDOR", *AMOUNTS,
            ratio(F.col("UTILIDAD"), F.col("IMPORTE_NETO")).alias("MARGEN_PCT"),
            "FACTURAS", "DEVOLUCIONES", "ARTICULOS_DISTINTOS",
            ratio(F.col("FACTURADO"), F.col("FACTURAS")).alias("TICKET_PROMEDIO"),
        )
    )


def recency_segment(as_of: date) -> Column:
    idle = days_between(day(as_of), F.col("ULTIMA_COMPRA"))
    return (
        F.when(F.col("ULTIMA_COMPRA").isNull(), "Sin ventas")
        .when(idle <= 30, "Activo")
        .when(idle <= 90, "En riesgo")
        .when(idle <= 180, "Inactivo")
        .otherwise("Perdido")
    )


def customer_summary(t: Tables, as_of: date) -> DataFrame:
    """One row per customer, sold to or not: recency segment, last 12 months, growth."""
    fecha = F.col("FECHA")
    last_year = fecha >= months_back(as_of, 12)
    year_before = (fecha >= months_back(as_of, 24)) & (fecha < months_back(as_of, 12))
    # Dates from twelve months back on touch few calendar months, a bit each.
    months_ago = F.lit(as_of.year * 12 + as_of.month) - F.year(fecha) * 12 - F.month(fecha)
    active = F.when(is_invoice() & last_year, F.expr("shiftleft(1, MESES_ATRAS)"))
    sold = summarise(
        t["fact_ventas_articulo"].withColumn("MESES_ATRAS", F.pmod(months_ago, F.lit(31)).cast("int")),
        CUSTOMER,
        mins={"PRIMERA_COMPRA": fecha},
        maxs={"ULTIMA_COMPRA": F.when(is_invoice(), fecha)},
        sums={
            "IMPORTE_12M": only(last_year, F.col("IMPORTE_NETO")),
            "UTILIDAD_12M": only(last_year, F.col("UTILIDAD")),
            "IMPORTE_12M_ANTERIOR": only(year_before, F.col("IMPORTE_NETO")),
        },
        bits={"_MESES": active},
        distinct=[Distinct("DOCTO_VE_ID", {"FACTURAS_12M": is_invoice() & last_year})],
    ).withColumn("MESES_ACTIVOS_12M", F.coalesce(F.bit_count("_MESES"), F.lit(0)).cast("bigint"))
    idle = days_between(day(as_of), F.col("ULTIMA_COMPRA"))
    current, previous = F.col("IMPORTE_12M"), F.col("IMPORTE_12M_ANTERIOR")
    return (
        t["dim_clientes"]
        .select(*CUSTOMER, F.col("NOMBRE").alias("CLIENTE"), "ESTATUS", "VENDEDOR_ID")
        .join(sold, CUSTOMER, "left")
        .join(sellers(t), ["EMPRESA", "VENDEDOR_ID"], "left")
        .select(
            "EMPRESA", "CLIENTE_ID", "CLIENTE", "ESTATUS", "VENDEDOR_ID", "VENDEDOR",
            "PRIMERA_COMPRA", "ULTIMA_COMPRA",
            idle.alias("DIAS_SIN_COMPRAR"),
            recency_segment(as_of).alias("SEGMENTO_RECENCIA"),
            "IMPORTE_12M", "UTILIDAD_12M", "FACTURAS_12M", "MESES_ACTIVOS_12M",
            ratio(current, F.col("FACTURAS_12M")).alias("TICKET_PROMEDIO_12M"),
            "IMPORTE_12M_ANTERIOR",
            ratio(current - previous, previous).alias("CRECIMIENTO_PCT"),
        )
    )


def line_margin(t: Tables) -> DataFrame:
    """Margin per company, month and product line."""
    # The item says the line, so it is looked up first, a hot item spread; names join the few totals.
    item_lines = t["dim_articulos"].select(*ITEM, "LINEA_ARTICULO_ID")
    sold = summarise(
        spread_join(t["fact_ventas_articulo"].withColumn("MES", month(F.col("FECHA"))), item_lines, ITEM),
        ["EMPRESA", "MES", "LINEA_ARTICULO_ID"],
        sums=_sums("UNIDADES", *AMOUNTS),
        distinct=[
            Distinct("ARTICULO_ID", {"ARTICULOS_VENDIDOS": None}),
            Distinct("CLIENTE_ID", {"CLIENTES": None}),
        ],
    )
    return sold.join(lines(t), ["EMPRESA", "LINEA_ARTICULO_ID"], "left").select(
        "EMPRESA", "MES", "LINEA_ARTICULO_ID", "LINEA", "GRUPO_LINEA_ID", "UNIDADES", *AMOUNTS,
        ratio(F.col("UTILIDAD"), F.col("IMPORTE_NETO")).alias("MARGEN_PCT"),
        "ARTICULOS_VENDIDOS", "CLIENTES",
    )
