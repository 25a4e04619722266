"""Monthly sales and month-end stock with item codes, as the market report needs them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import day, month
from ..model import Tables
from ..operators.joins import Spread, heavy_hashes, join_beside, spread_join, would_broadcast
from .catalog import DEFAULT_CHANNEL, customer_type_channels, item_codes
from .dims import CUSTOMER, ITEM, WAREHOUSE, default_supplier_name, warehouses
from .inventory import closing_stock, fill_months, stock_changes

NO_ZONE = "Sin zona"
MEASURES = {
    "PIEZAS": "UNIDADES",
    "IMPORTE_SIN_IMPUESTOS": "IMPORTE_NETO",
    "IMPUESTOS": "IMPUESTOS",
    "IMPORTE_CON_IMPUESTOS": "IMPORTE_TOTAL",
}


def _label_items(df: DataFrame, t: Tables, dealt: Spread | None = None) -> DataFrame:
    """Everything the report prints about an item; one shuffle by item at most serves all three lookups, none if it is ``dealt``."""
    names = t["dim_articulos"].select(*ITEM, F.col("NOMBRE").alias("DESCRIPCION"), "UNIDAD_VENTA")
    codes = item_codes(t).select(*ITEM, "CLAVE_PRINCIPAL", "CODIGO_BARRAS")
    for lookup in (names, codes, default_supplier_name(t)):
        if dealt is None:
            df = df.join(lookup, ITEM, "left")
        else:
            df = join_beside(df, dealt.copied(lookup), dealt.keys[1:], dealt.keys[:1])
    return df


def market_sales(t: Tables, mes: date | None = None) -> DataFrame:
    """Net sales per month, channel, zone, warehouse and item. ``mes`` reads that month alone."""
    sales = t["fact_ventas_articulo"]
    if mes is not None:
        first = mes.replace(day=1)
        sales = sales.filter(F.col("FECHA").between(day(first), F.last_day(day(first))))
    channels = customer_type_channels(t, with_company=True).select(
        "EMPRESA", "TIPO_CLIENTE_ID", "FORMATO", "INCLUIR", "ZONA"
    )
    customers = t["dim_clientes"].select(*CUSTOMER, "TIPO_CLIENTE_ID")
    keys = ["EMPRESA", "MES", "FORMATO", "INCLUIR", "ZONA", "ALMACEN_ID", "ARTICULO_ID"]
    # The customer is all that says the channel. Each lookup is a table by itself: small ones are broadcast, and a hot customer
    # of a large one is spread. The groups are nearly as fine as the rows, so nothing would combine: the rows, narrower than
    # their sums, are dealt by item once, for the sums and for what is printed about items, and get the names of their channel
    # there. The rows of a hot item are dealt to several parts by month and warehouse. The company, of which there is one,
    # deals nothing.
    sales = sales.withColumn("MES", month(F.col("FECHA")))
    keyed = [ITEM] if would_broadcast(customers) else [ITEM, CUSTOMER]
    heavy = heavy_hashes(sales, keyed)
    by_item = Spread(ITEM, heavy[0])
    sold = spread_join(sales, customers, CUSTOMER, heavy=heavy[-1]).select(
        "EMPRESA", "MES", "TIPO_CLIENTE_ID", "ALMACEN_ID", "ARTICULO_ID", *MEASURES.values()
    )
    totals = (
        by_item.dealt(sold, ["MES", "ALMACEN_ID"])
        .repartition(*by_item.keys[1:])
        .join(channels, ["EMPRESA", "TIPO_CLIENTE_ID"], "left")
        .withColumns(
            {
                "FORMATO": F.coalesce("FORMATO", F.lit(DEFAULT_CHANNEL)),
                "INCLUIR": F.coalesce("INCLUIR", F.lit(True)),
                "ZONA": F.coalesce("ZONA", F.lit(NO_ZONE)),
            }
        )
        .groupBy(*dict.fromkeys([*keys, *by_item.keys]))
        .agg(*[F.sum(c).alias(n) for n, c in MEASURES.items()])
    )
    return (
        _label_items(totals, t, by_item)
        .join(warehouses(t), WAREHOUSE, "left")
        .select(
            "EMPRESA", "MES", "FORMATO", "INCLUIR", "ZONA", "ALMACEN_ID", "ALMACEN", "ARTICULO_ID",
            "CLAVE_PRINCIPAL", "CODIGO_BARRAS", "DESCRIPCION", "UNIDAD_VENTA", "PROVEEDOR", *MEASURES,
        )
    )


def market_inventory(t: Tables, as_of: date, mes: date | None = None) -> DataFrame:
    """Month-end stock and value with item codes and supplier. ``mes`` computes that month alone."""
    stock = stock_changes(t, as_of, with_sales=False) if mes is None else closing_stock(t, as_of, mes)
    labelled = _label_items(stock, t).join(warehouses(t), WAREHOUSE, "left")
    if mes is None:
        labelled = fill_months(labelled, {})
    return labelled.select(
        "EMPRESA", F.col("PERIODO").alias("MES"), "ALMACEN_ID", "ALMACEN", "ARTICULO_ID",
        "CLAVE_PRINCIPAL", "CODIGO_BARRAS", "DESCRIPCION", "UNIDAD_VENTA", "PROVEEDOR",
        "EXISTENCIA_FIN_MES", "VALOR_COSTO_FIN_MES",
    )
