"""V08 net purchases by supplier, V09 last cost by item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_receipt, is_return, month, not_cancelled, only, ratio, signed
from ..model import Tables
from ..operators.aggregates import Distinct, pick_last, summarise
from .dims import ITEM, default_supplier, items, suppliers, with_item_and_warehouse


def supplier_month_purchases(t: Tables) -> DataFrame:
    """Receipts add, every other type subtracts; unit cost from receipts alone."""
    units, amount = F.col("UNIDADES"), F.col("PRECIO_TOTAL_NETO")
    bought = summarise(
        t["fact_compras_partidas"].filter(not_cancelled()).withColumn("MES", month(F.col("FECHA"))),
        ["EMPRESA", "MES", "PROVEEDOR_ID", "ARTICULO_ID", "ALMACEN_ID"],
        sums={
            "UNIDADES_NETAS": signed(is_receipt(), units),
            "IMPORTE_NETO": signed(is_receipt(), amount),
            "RECIBIDO": only(is_receipt(), amount),
            "RECIBIDAS": only(is_receipt(), units),
        },
        distinct=[Distinct("DOCTO_CM_ID", {"COMPRAS": is_receipt(), "DEVOLUCIONES": is_return()})],
        fine_keys=True,
    )
    named = with_item_and_warehouse(bought, t).join(suppliers(t), ["EMPRESA", "PROVEEDOR_ID"], "left")
    return named.select(
        "EMPRESA", "MES", "PROVEEDOR_ID", "PROVEEDOR", "ARTICULO_ID", "ARTICULO", "LINEA_ARTICULO_ID", "LINEA",
        "ALMACEN_ID", "ALMACEN", F.col("UNIDADES_NETAS").alias("UNIDADES"), "IMPORTE_NETO",
        ratio(F.col("RECIBIDO"), F.col("RECIBIDAS")).alias("COSTO_UNITARIO_PROM"),
        "COMPRAS", "DEVOLUCIONES",
    )


def last_item_cost(t: Tables) -> DataFrame:
    """Per item the last receipt and the default supplier."""
    last = pick_last(
        t["fact_compras_partidas"].filter(is_receipt() & not_cancelled() & (F.col("UNIDADES") > 0)),
        ITEM,
        ["FECHA", "DOCTO_CM_DET_ID"],
        ["FECHA", "PROVEEDOR_ID", "PRECIO_UNITARIO", "UNIDADES"],
    ).select(
        *ITEM,
        F.col("PROVEEDOR_ID").alias("PROVEEDOR_ULT_COMPRA_ID"),
        F.col("FECHA").alias("FECHA_ULT_COMPRA"),
        F.col("PRECIO_UNITARIO").alias("ULTIMO_COSTO"),
        F.col("UNIDADES").alias("UNIDADES_ULT_COMPRA"),
    )
    default = default_supplier(t, ["PROVEEDOR_ID", "DIAS_ENTREGA_PROM", "NUM_COMPRAS"]).withColumnRenamed(
        "PROVEEDOR_ID", "PROVEEDOR_PREDET_ID"
    )
    return (
        items(t)
        .join(last, ITEM, "left")
        .join(default, ITEM, "left")
        .join(suppliers(t, "PROVEEDOR_ULT_COMPRA_ID", "PROVEEDOR_ULT_COMPRA"), ["EMPRESA", "PROVEEDOR_ULT_COMPRA_ID"], "left")
        .join(suppliers(t, "PROVEEDOR_PREDET_ID", "PROVEEDOR_PREDET"), ["EMPRESA", "PROVEEDOR_PREDET_ID"], "left")
        .select(
            "EMPRESA", "ARTICULO_ID", "ARTICULO", F.col("ARTICULO_ESTATUS").alias("ESTATUS"),
            "LINEA_ARTICULO_ID", "LINEA", "PROVEEDOR_ULT_COMPRA_ID", "PROVEEDOR_ULT_COMPRA", "FECHA_ULT_COMPRA",
            "ULTIMO_COSTO", "UNIDADES_ULT_COMPRA", "PROVEEDOR_PREDET_ID", "PROVEEDOR_PREDET",
            "DIAS_ENTREGA_PROM", "NUM_COMPRAS",
        )
    )
