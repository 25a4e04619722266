"""Dimension lookups.

Every key carries the company, so two companies may reuse the same ids. Only the needed
columns are kept; whether a lookup is broadcast is left to the optimizer, which checks
its size, and a large one becomes a shuffled join whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Tables
from ..operators.aggregates import pick_first

ITEM = ["EMPRESA", "ARTICULO_ID"]
WAREHOUSE = ["EMPRESA", "ALMACEN_ID"]
CUSTOMER = ["EMPRESA", "CLIENTE_ID"]


def articles(t: Tables) -> DataFrame:
    return t["dim_articulos"].select(
        *ITEM,
        F.col("NOMBRE").alias("ARTICULO"),
        F.col("ESTATUS").alias("ARTICULO_ESTATUS"),
        "UNIDAD_VENTA",
        "LINEA_ARTICULO_ID",
    )


def lines(t: Tables) -> DataFrame:
    return t["dim_lineas"].select("EMPRESA", "LINEA_ARTICULO_ID", F.col("NOMBRE").alias("LINEA"), "GRUPO_LINEA_ID")


def with_items(df: DataFrame, t: Tables) -> DataFrame:
    """Item and line by name. Each lookup is joined by itself: the size of one is known, that of their join is a guess."""
    return df.join(articles(t), ITEM, "left").join(lines(t), ["EMPRESA", "LINEA_ARTICULO_ID"], "left")


def items(t: Tables) -> DataFrame:
    """EMPRESA, ARTICULO_ID, ARTICULO, ARTICULO_ESTATUS, UNIDAD_VENTA, LINEA_ARTICULO_ID, LINEA, GRUPO_LINEA_ID."""
    return articles(t).join(lines(t), ["EMPRESA", "LINEA_ARTICULO_ID"], "left")


def warehouses(t: Tables) -> DataFrame:
    return t["dim_almacenes"].select(*WAREHOUSE, F.col("NOMBRE").alias("ALMACEN"))


def sellers(t: Tables) -> DataFrame:
    return t["dim_vendedores"].select("EMPRESA", "VENDEDOR_ID", F.col("NOMBRE").alias("VENDEDOR"))


def suppliers(t: Tables, id_as: str = "PROVEEDOR_ID", name_as: str = "PROVEEDOR") -> DataFrame:
    return t["dim_proveedores"].select(
        "EMPRESA", F.col("PROVEEDOR_ID").alias(id_as), F.col("NOMBRE").alias(name_as)
    )


def default_supplier(t: Tables, carry: list[str]) -> DataFrame:
    """One default supplier per item: unranked first, then by rank, then by the oldest price row."""
    flagged = t["dim_articulo_proveedor"].filter("ES_PROV_PREDET")
    return pick_first(flagged, ITEM, ["PRIORIDAD_COMPRA", "PRECIO_COMPRA_ID"], carry)


def default_supplier_name(t: Tables) -> DataFrame:
    return (
        default_supplier(t, ["PROVEEDOR_ID"])
        .join(suppliers(t), ["EMPRESA", "PROVEEDOR_ID"], "left")
        .select(*ITEM, "PROVEEDOR")
    )


def with_item_and_warehouse(df: DataFrame, t: Tables) -> DataFrame:
    return with_items(df, t).join(warehouses(t), WAREHOUSE, "left")
