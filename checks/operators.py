"""Registered queries for single operators: filters (F), joins (JN), aggregations (A), windows (W), order (O), unions (U)
and scalar functions (FN), each over whole tables and next to its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.functions.columns import (
    blank_to_null, day, days_between, is_invoice, is_return, month, months_back, not_cancelled, only, ratio, strip,
)
from tianguis.model import Tables
from tianguis.operators.aggregates import Distinct, pick_first, pick_last, summarise
from tianguis.operators.joins import spread_join
from tianguis.plans import catalog, dims, inventory, report
from tianguis.sources.feeds import union_all
from tianguis.sources.rules import good_rules

from .ingest import SALE_AMOUNTS, SALE_COLS, both
from .oracles import CODES, DAY0, MES, SERIES, SERIES_TABLES, SQL, dbl, div9
from .tables import AS_OF, ctes

V, C = "fact_ventas_articulo", "fact_compras_partidas"
BUY_KEYS = "DOCTO_CM_DET_ID, DOCTO_CM_ID, TIPO_DOCTO, ESTATUS, FECHA, ARTICULO_ID"
BUY = [c.strip() for c in BUY_KEYS.split(",")]
SALE = [c.strip() for c in SALE_COLS.split(",")]


def sales_where(sql: str) -> str:
    return f"{ctes(V)} SELECT {SALE_COLS}, {dbl('UNIDADES')} FROM {V} WHERE {sql}"


def sales_rows(t: Tables, test) -> DataFrame:
    return t[V].filter(test).select(*SALE, "UNIDADES")


# --- filters ---
both("F1_estatus_distinto", lambda t: t[C].filter(not_cancelled()).select(*BUY), f"{ctes(C)} SELECT {BUY_KEYS} FROM {C} WHERE ESTATUS <> 'C'")
both(
    "F2_rango_contra_fecha",
    lambda t: sales_rows(t, (F.col("FECHA") >= months_back(AS_OF, 24)) & (F.col("FECHA") < months_back(AS_OF, 12))),
    sales_where("FECHA >= DATE '1999-08-01' AND FECHA < DATE '2000-08-01'"),
)
both(
    "F3_bandera",
    lambda t: t["dim_articulo_proveedor"].filter("ES_PROV_PREDET").select("PRECIO_COMPRA_ID", "ARTICULO_ID", "PROVEEDOR_ID"),
    f"{ctes('dim_articulo_proveedor')} SELECT PRECIO_COMPRA_ID, ARTICULO_ID, PROVEEDOR_ID FROM dim_articulo_proveedor WHERE ES_PROV_PREDET",
)
both(
    "F4_no_vacio",
    lambda t: t["dim_articulo_claves"].select("CLAVE_ARTICULO_ID", blank_to_null(F.col("CLAVE_ARTICULO")).alias("CLAVE")).filter("CLAVE IS NOT NULL"),
    f"{ctes('dim_articulo_claves')} SELECT CLAVE_ARTICULO_ID, trim(CLAVE_ARTICULO) AS CLAVE FROM dim_articulo_claves WHERE trim(CLAVE_ARTICULO) <> ''",
)
both(
    "F5_nulo_o_mayor",
    lambda t: t[C].filter(F.col("ESTATUS").isNull() | (F.col("UNIDADES") > 45)).select(*BUY),
    f"{ctes(C)} SELECT {BUY_KEYS} FROM {C} WHERE ESTATUS IS NULL OR UNIDADES > 45",
)
both(
    "F6_alguno_no_cero",
    lambda t: t["fact_saldos_mensuales"]
    .filter((F.coalesce("SALIDAS_UNIDADES", F.lit(0)) != 0) | (F.coalesce("SALIDAS_COSTO", F.lit(0)) != 0))
    .select("PERIODO", "ARTICULO_ID", "ALMACEN_ID", "SALIDAS_UNIDADES"),
    f"""{ctes('fact_saldos_mensuales')} SELECT PERIODO, ARTICULO_ID, ALMACEN_ID, {dbl('SALIDAS_UNIDADES')} FROM fact_saldos_mensuales
WHERE coalesce(SALIDAS_UNIDADES, 0) <> 0 OR coalesce(SALIDAS_COSTO, 0) <> 0""",
)
both(
    "F7_patron",
    lambda t: t["dim_articulo_claves"].filter(strip(F.col("CLAVE_ARTICULO")).rlike(catalog.BARCODE)).select("CLAVE_ARTICULO_ID", "CLAVE_ARTICULO"),
    f"""{ctes('dim_articulo_claves')} SELECT CLAVE_ARTICULO_ID, CLAVE_ARTICULO FROM dim_articulo_claves
WHERE regexp_full_match(trim(CLAVE_ARTICULO), '[0-9]{{12,14}}')""",
)


def _parameters(t: Tables) -> DataFrame:
    query = "SELECT * FROM {ventas} WHERE EMPRESA = :empresa AND FECHA BETWEEN :desde AND :hasta"
    args = {"empresa": "E1", "desde": AS_OF.replace(year=2000), "hasta": AS_OF}
    return t[V].sparkSession.sql(query, args=args, ventas=t[V]).select(*SALE, "UNIDADES")


both("F8_parametros", _parameters, sales_where("EMPRESA = 'E1' AND FECHA BETWEEN DATE '2000-08-01' AND DATE '2001-08-01'"))
both(
    "F9_casos",
    lambda t: t[V].select(
        *SALE,
        F.when(days_between(day(AS_OF), F.col("FECHA")) <= 30, "reciente").when(days_between(day(AS_OF), F.col("FECHA")) <= 365, "del año")
        .otherwise("antiguo").alias("EDAD"),
    ),
    f"""{ctes(V)} SELECT {SALE_COLS}, CASE WHEN date_diff('day', FECHA, {DAY0}) <= 30 THEN 'reciente' WHEN date_diff('day', FECHA, {DAY0}) <= 365 THEN 'del año'
  ELSE 'antiguo' END AS EDAD FROM {V}""",
)
both(
    "F10_valores_por_omision",
    lambda t: t["dim_clientes"].select("CLIENTE_ID", F.coalesce("TIPO_CLIENTE_ID", F.lit(0)).alias("TIPO"), F.nullif(F.col("ESTATUS"), F.lit("B")).alias("ACTIVO")),
    f"{ctes('dim_clientes')} SELECT CLIENTE_ID, coalesce(TIPO_CLIENTE_ID, 0) AS TIPO, nullif(ESTATUS, 'B') AS ACTIVO FROM dim_clientes",
)
both(
    "F11_columnas_permitidas",
    lambda t: t[V].select("FECHA", "ARTICULO_ID", "ALMACEN_ID", "UNIDADES", "IMPORTE_NETO"),
    f"{ctes(V)} SELECT FECHA, ARTICULO_ID, ALMACEN_ID, {dbl('UNIDADES IMPORTE_NETO')} FROM {V}",
)

# --- joins ---
both(
    "JN1_hecho_dimensiones",
    lambda t: dims.with_item_and_warehouse(t[V], t).select(*SALE, "ARTICULO", "LINEA", "ALMACEN"),
    f"""{ctes(f'{V} dim_articulos dim_lineas dim_almacenes')} SELECT {', '.join('v.' + c for c in SALE)}, a.NOMBRE AS ARTICULO, l.NOMBRE AS LINEA, al.NOMBRE AS ALMACEN
FROM {V} v LEFT JOIN dim_articulos a ON a.ARTICULO_ID = v.ARTICULO_ID LEFT JOIN dim_lineas l ON l.LINEA_ARTICULO_ID = a.LINEA_ARTICULO_ID
LEFT JOIN dim_almacenes al ON al.ALMACEN_ID = v.ALMACEN_ID""",
)
both(
    "JN1_claves_calientes",
    lambda t: spread_join(
        spread_join(t[V], t["dim_clientes"].select(*dims.CUSTOMER, F.col("NOMBRE").alias("CLIENTE")), dims.CUSTOMER, partitions=2_000),
        dims.articles(t).select(*dims.ITEM, "ARTICULO"), dims.ITEM, "inner", partitions=2_000,
    ).select(*SALE, "CLIENTE", "ARTICULO"),
    f"""{ctes(f'{V} dim_articulos dim_clientes')} SELECT {', '.join('v.' + c for c in SALE)}, quien.NOMBRE AS CLIENTE, que.NOMBRE AS ARTICULO
FROM dim_articulos que JOIN {V} v USING (EMPRESA, ARTICULO_ID) LEFT JOIN dim_clientes quien ON quien.EMPRESA = v.EMPRESA AND quien.CLIENTE_ID = v.CLIENTE_ID""",
)
both(
    "JN2_dimension_totales",
    lambda t: t["dim_clientes"].select("EMPRESA", "CLIENTE_ID").join(
        summarise(t[V], dims.CUSTOMER, sums={"IMPORTE_NETO": F.col("IMPORTE_NETO")}), dims.CUSTOMER, "left"),
    f"""{ctes(f'dim_clientes {V}')} SELECT c.EMPRESA, c.CLIENTE_ID, CAST(sum(IMPORTE_NETO) AS DOUBLE) AS IMPORTE_NETO
FROM dim_clientes c LEFT JOIN {V} v ON v.CLIENTE_ID = c.CLIENTE_ID GROUP BY 1, 2""",
)


def _stock_and_sales(t: Tables) -> DataFrame:
    sold = summarise(t[V], inventory.STOCK_KEY, sums={"VENDIDAS": F.col("UNIDADES")})
    return inventory.latest_snapshot(t).join(sold, inventory.STOCK_KEY, "left").select("ARTICULO_ID", "ALMACEN_ID", "EXISTENCIA", "VENDIDAS")


both(
    "JN3_varias_claves",
    _stock_and_sales,
    f"""{ctes(f'inventario_existencias {V}')}, s AS (SELECT ARTICULO_ID, ALMACEN_ID, sum(UNIDADES) AS u FROM {V} GROUP BY 1, 2)
SELECT e.ARTICULO_ID, e.ALMACEN_ID, CAST(EXISTENCIA AS DOUBLE) AS EXISTENCIA, CAST(u AS DOUBLE) AS VENDIDAS FROM inventario_existencias e
LEFT JOIN s ON s.ARTICULO_ID = e.ARTICULO_ID AND s.ALMACEN_ID = e.ALMACEN_ID WHERE _snapshot_date = (SELECT max(_snapshot_date) FROM inventario_existencias)""",
)


def _channel_of_customers(t: Tables) -> DataFrame:
    types = catalog.customer_type_channels(t, with_company=True).select("EMPRESA", "TIPO_CLIENTE_ID", "ORDEN_REGLA")
    return t["dim_clientes"].join(types, ["EMPRESA", "TIPO_CLIENTE_ID"], "left").select("CLIENTE_ID", "TIPO_CLIENTE_ID", "ORDEN_REGLA")


both(
    "JN4_reglas_por_patron",
    _channel_of_customers,
    f"""{ctes('dim_clientes dim_tipos_clientes dim_formato_venta')} SELECT c.CLIENTE_ID, c.TIPO_CLIENTE_ID, min(f.ORDEN) AS ORDEN_REGLA FROM dim_clientes c
LEFT JOIN dim_tipos_clientes t ON t.TIPO_CLIENTE_ID = c.TIPO_CLIENTE_ID LEFT JOIN dim_formato_venta f ON regexp_matches(trim(t.NOMBRE), '(?i)' || f.PATRON) GROUP BY 1, 2""",
)
both(
    "JN5_ultima_fotografia",
    lambda t: inventory.latest_snapshot(t),
    f"""{ctes('inventario_existencias')} SELECT EMPRESA, _snapshot_date, ARTICULO_ID, ALMACEN_ID, {dbl('EXISTENCIA COSTO')} FROM inventario_existencias e
JOIN (SELECT max(_snapshot_date) AS d FROM inventario_existencias) u ON e._snapshot_date = u.d""",
)
both(
    "JN6_semi",
    lambda t: t[V].join(t["dim_articulo_proveedor"].filter("ES_PROV_PREDET"), dims.ITEM, "left_semi").select(*SALE),
    f"""{ctes(f'{V} dim_articulo_proveedor')} SELECT {SALE_COLS} FROM {V} JOIN (SELECT DISTINCT ARTICULO_ID FROM dim_articulo_proveedor WHERE ES_PROV_PREDET)
USING (ARTICULO_ID)""",
)


def _month_grid(t: Tables) -> DataFrame:
    last = F.trunc(day(AS_OF), "MM")
    rows = t["fact_saldos_mensuales"].filter(F.col("PERIODO") <= last)  # a sequence must not run backwards
    first = rows.groupBy(*inventory.STOCK_KEY).agg(F.min("PERIODO").alias("DESDE"))
    span = F.sequence("DESDE", last, F.expr("interval 1 month"))
    return first.select("ARTICULO_ID", "ALMACEN_ID", F.explode(span).alias("PERIODO"))


both("JN7_malla_de_meses", _month_grid, f"{ctes(SERIES_TABLES)}, {SERIES} SELECT ARTICULO_ID, ALMACEN_ID, PERIODO FROM serie")


def _two_suppliers(t: Tables) -> DataFrame:
    last = pick_last(t[C].filter("TIPO_DOCTO = 'C'"), dims.ITEM, ["FECHA", "DOCTO_CM_DET_ID"], ["PROVEEDOR_ID"]).withColumnRenamed("PROVEEDOR_ID", "ULT")
    default = dims.default_supplier(t, ["PROVEEDOR_ID"]).withColumnRenamed("PROVEEDOR_ID", "PREDET")
    rows = last.join(default, dims.ITEM, "left")
    rows = rows.join(dims.suppliers(t, "ULT", "ULT_NOMBRE"), ["EMPRESA", "ULT"], "left").join(dims.suppliers(t, "PREDET", "PREDET_NOMBRE"), ["EMPRESA", "PREDET"], "left")
    return rows.select("ARTICULO_ID", "ULT_NOMBRE", "PREDET_NOMBRE")


both(
    "JN8_misma_dimension_dos_veces",
    _two_suppliers,
    f"""{ctes(f'{C} dim_articulo_proveedor dim_proveedores')}, u AS (SELECT ARTICULO_ID, PROVEEDOR_ID FROM {C} WHERE TIPO_DOCTO = 'C'
  QUALIFY row_number() OVER (PARTITION BY ARTICULO_ID ORDER BY FECHA DESC, DOCTO_CM_DET_ID DESC, PROVEEDOR_ID DESC) = 1),
d AS (SELECT ARTICULO_ID, PROVEEDOR_ID FROM dim_articulo_proveedor WHERE ES_PROV_PREDET
  QUALIFY row_number() OVER (PARTITION BY ARTICULO_ID ORDER BY PRIORIDAD_COMPRA NULLS FIRST, PRECIO_COMPRA_ID) = 1)
SELECT u.ARTICULO_ID, pu.NOMBRE AS ULT_NOMBRE, pd.NOMBRE AS PREDET_NOMBRE FROM u LEFT JOIN d USING (ARTICULO_ID)
LEFT JOIN dim_proveedores pu ON pu.PROVEEDOR_ID = u.PROVEEDOR_ID LEFT JOIN dim_proveedores pd ON pd.PROVEEDOR_ID = d.PROVEEDOR_ID""",
)
both(
    "JN9_articulo_con_claves",
    lambda t: t["dim_articulos"].join(catalog.item_codes(t), dims.ITEM, "left").select("ARTICULO_ID", "CLAVE_PRINCIPAL", "CODIGO_BARRAS", "CLAVE_ALTERNA"),
    f"""{ctes('dim_articulos dim_articulo_claves')}, {CODES} SELECT a.ARTICULO_ID, k.CLAVE_PRINCIPAL, k.CODIGO_BARRAS, k.CLAVE_ALTERNA FROM dim_articulos a
LEFT JOIN codigos k ON k.ARTICULO_ID = a.ARTICULO_ID""",
)

# --- aggregations ---
both(
    "A1_agrupar",
    lambda t: t[V].groupBy("EMPRESA", "FECHA", "VENDEDOR_ID", "ALMACEN_ID", "TIPO_DOCTO").agg(F.count(F.lit(1)).alias("n")),
    f"{ctes(V)} SELECT EMPRESA, FECHA, VENDEDOR_ID, ALMACEN_ID, TIPO_DOCTO, count(*) AS n FROM {V} GROUP BY 1, 2, 3, 4, 5",
)
both(
    "A2_sumas_con_nulos",
    lambda t: summarise(t[V].withColumn("MES", month(F.col("FECHA"))), ["MES"], sums={"IMPUESTOS": F.col("IMPUESTOS"), "IMPORTE_TOTAL": F.col("IMPORTE_TOTAL")}),
    f"""{ctes(V)} SELECT {MES} AS MES, CAST(sum(IMPUESTOS) AS DOUBLE) AS IMPUESTOS, CAST(sum(IMPORTE_TOTAL) AS DOUBLE) AS IMPORTE_TOTAL FROM {V} GROUP BY 1""",
)
both(
    "A3_suma_condicional",
    lambda t: summarise(t[V], ["CLIENTE_ID"], sums={"FACTURADO": only(is_invoice(), F.col("IMPORTE_NETO")), "DEVUELTO": only(is_return(), -F.col("IMPORTE_NETO"))}),
    f"""{ctes(V)} SELECT CLIENTE_ID, CAST(sum(CASE WHEN TIPO_DOCTO = 'F' THEN IMPORTE_NETO ELSE 0 END) AS DOUBLE) AS FACTURADO,
  CAST(sum(CASE WHEN TIPO_DOCTO = 'D' THEN -IMPORTE_NETO ELSE 0 END) AS DOUBLE) AS DEVUELTO FROM {V} GROUP BY 1""",
)
both(
    "A4_conteos_distintos",
    lambda t: summarise(
        t[V], ["ALMACEN_ID"],
        distinct=[Distinct("DOCTO_VE_ID", {"FACTURAS": is_invoice(), "DEVOLUCIONES": is_return()}), Distinct("ARTICULO_ID", {"ARTICULOS": None}),
                  Distinct("CLIENTE_ID", {"CLIENTES": None})],
    ),
    f"""{ctes(V)} SELECT ALMACEN_ID, count(DISTINCT CASE WHEN TIPO_DOCTO = 'F' THEN DOCTO_VE_ID END) AS FACTURAS,
  count(DISTINCT CASE WHEN TIPO_DOCTO = 'D' THEN DOCTO_VE_ID END) AS DEVOLUCIONES, count(DISTINCT ARTICULO_ID) AS ARTICULOS,
  count(DISTINCT CLIENTE_ID) AS CLIENTES FROM {V} GROUP BY 1""",
)
both(
    "A5_razon_de_sumas",
    lambda t: summarise(t[V], ["ARTICULO_ID"], sums={"u": F.col("UTILIDAD"), "n": only(F.col("FECHA") >= months_back(AS_OF, 3), F.col("IMPORTE_NETO"))})
    .select("ARTICULO_ID", ratio(F.col("u"), F.col("n")).alias("RAZON")),
    f"""{ctes(V)}, g AS (SELECT ARTICULO_ID, sum(UTILIDAD) AS u, sum(CASE WHEN FECHA >= DATE '2001-05-01' THEN IMPORTE_NETO ELSE 0 END) AS n FROM {V} GROUP BY 1)
SELECT ARTICULO_ID, {div9('u', 'n')} AS RAZON FROM g""",
)
both(
    "A6_extremos",
    lambda t: t[V].groupBy("CLIENTE_ID").agg(F.min("FECHA").alias("PRIMERA"), F.max(F.when(is_return(), F.col("FECHA"))).alias("ULTIMA_DEVOLUCION")),
    f"{ctes(V)} SELECT CLIENTE_ID, min(FECHA) AS PRIMERA, max(CASE WHEN TIPO_DOCTO = 'D' THEN FECHA END) AS ULTIMA_DEVOLUCION FROM {V} GROUP BY 1",
)
both(
    "A7_o_logico",
    lambda t: t["fact_saldos_mensuales"].groupBy("ARTICULO_ID").agg(F.bool_or("ES_SALDO_INICIAL").alias("CON_INICIAL")),
    f"{ctes('fact_saldos_mensuales')} SELECT ARTICULO_ID, bool_or(ES_SALDO_INICIAL) AS CON_INICIAL FROM fact_saldos_mensuales GROUP BY 1",
)
both(
    "A8_cualquier_valor",
    lambda t: t["dim_articulo_claves"].groupBy("ARTICULO_ID").agg(F.any_value("EMPRESA").alias("EMPRESA")),
    f"{ctes('dim_articulo_claves')} SELECT ARTICULO_ID, any_value(EMPRESA) AS EMPRESA FROM dim_articulo_claves GROUP BY 1",
)
both(
    "A9_escalares",
    lambda t: t["fact_saldos_mensuales"].agg(F.min("PERIODO").alias("DESDE"), F.max("PERIODO").alias("HASTA")),
    f"{ctes('fact_saldos_mensuales')} SELECT min(PERIODO) AS DESDE, max(PERIODO) AS HASTA FROM fact_saldos_mensuales",
)
both(
    "A10_distintos",
    lambda t: t["dim_articulo_proveedor"].filter("ES_PROV_PREDET").select("ARTICULO_ID").distinct(),
    f"{ctes('dim_articulo_proveedor')} SELECT DISTINCT ARTICULO_ID FROM dim_articulo_proveedor WHERE ES_PROV_PREDET",
)


def _all_months_sheet(t: Tables, with_stock: bool) -> DataFrame:
    """Detail, totals and stock row of the whole sales table, cut by seller name."""
    cut = dims.sellers(t)
    rows = t[V].join(cut, ["EMPRESA", "VENDEDOR_ID"], "left").select(
        F.col("VENDEDOR").alias("CORTE"), F.col("UNIDADES").alias("PIEZAS"), F.col("IMPORTE_NETO").alias("IMPORTE_SIN_IMPUESTOS"),
        "IMPUESTOS", F.col("IMPORTE_TOTAL").alias("IMPORTE_CON_IMPUESTOS"))
    stock = inventory.latest_snapshot(t).select(F.col("EXISTENCIA").alias("EXISTENCIA_FIN_MES"), F.col("COSTO").alias("VALOR_COSTO_FIN_MES"))
    out = report.summary_sheet(rows, stock)
    if with_stock:
        return out.filter("SECCION = 'Inventario'").select("RENGLONES", "EXISTENCIA_FIN_MES", "VALOR_COSTO_FIN_MES")
    return out.filter("SECCION <> 'Inventario'").drop("EXISTENCIA_FIN_MES", "VALOR_COSTO_FIN_MES")


_M = {"PIEZAS": "UNIDADES", "IMPORTE_SIN_IMPUESTOS": "IMPORTE_NETO", "IMPUESTOS": "IMPUESTOS", "IMPORTE_CON_IMPUESTOS": "IMPORTE_TOTAL"}
_MS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS DOUBLE) AS {n}" for n, c in _M.items())
both(
    "A11_detalle_y_total",
    lambda t: _all_months_sheet(t, False),
    f"""{ctes(f'{V} dim_vendedores')}, r AS (SELECT v.*, NOMBRE FROM {V} v LEFT JOIN dim_vendedores USING (VENDEDOR_ID))
SELECT 'Ventas' AS SECCION, coalesce(NOMBRE, '(sin dato)') AS CORTE, count(*) AS RENGLONES, {_MS} FROM r GROUP BY 2
UNION ALL SELECT 'Total', 'Total', count(*), {_MS} FROM r""",
)
both(
    "A12_totales_inventario",
    lambda t: _all_months_sheet(t, True),
    f"""{ctes('inventario_existencias')} SELECT count(*) AS RENGLONES, CAST(sum(EXISTENCIA) AS DOUBLE) AS EXISTENCIA_FIN_MES, CAST(sum(COSTO) AS DOUBLE) AS VALOR_COSTO_FIN_MES
FROM inventario_existencias WHERE _snapshot_date = DATE '2001-08-01'""",
)

# --- windows ---
both(
    "W1_primero_por_clave",
    lambda t: pick_last(t[V].filter(is_invoice()), ["CLIENTE_ID"], ["FECHA", "DOCTO_VE_ID", "ARTICULO_ID", "UNIDADES"], ["FECHA", "DOCTO_VE_ID", "ARTICULO_ID", "UNIDADES"]),
    f"""{ctes(V)} SELECT CLIENTE_ID, FECHA, DOCTO_VE_ID, ARTICULO_ID, {dbl('UNIDADES')} FROM {V} WHERE TIPO_DOCTO = 'F'
QUALIFY row_number() OVER (PARTITION BY CLIENTE_ID ORDER BY FECHA DESC, DOCTO_VE_ID DESC, ARTICULO_ID DESC, UNIDADES DESC) = 1""",
)
both(
    "W2_nulos_primero",
    lambda t: pick_first(t["dim_articulo_proveedor"], ["PROVEEDOR_ID"], ["PRIORIDAD_COMPRA", "PRECIO_COMPRA_ID"], ["PRIORIDAD_COMPRA", "PRECIO_COMPRA_ID"]),
    f"""{ctes('dim_articulo_proveedor')} SELECT PROVEEDOR_ID, PRIORIDAD_COMPRA, PRECIO_COMPRA_ID FROM dim_articulo_proveedor
QUALIFY row_number() OVER (PARTITION BY PROVEEDOR_ID ORDER BY PRIORIDAD_COMPRA NULLS FIRST, PRECIO_COMPRA_ID) = 1""",
)


def _running(t: Tables) -> DataFrame:
    monthly = t["fact_saldos_mensuales"].groupBy("EMPRESA", "ARTICULO_ID", "PERIODO").agg(F.sum("ENTRADAS_UNIDADES").alias("e"))
    series = Window.partitionBy("EMPRESA", "ARTICULO_ID").orderBy("PERIODO")
    return monthly.select("ARTICULO_ID", "PERIODO", F.sum("e").over(series).alias("ACUMULADO"))


both(
    "W3_suma_acumulada",
    _running,
    f"""{ctes('fact_saldos_mensuales')} SELECT ARTICULO_ID, PERIODO, CAST(sum(sum(ENTRADAS_UNIDADES)) OVER (PARTITION BY ARTICULO_ID ORDER BY PERIODO) AS DOUBLE) AS ACUMULADO
FROM fact_saldos_mensuales GROUP BY 1, 2""",
)

# --- order, limit, union ---
both(
    "O1_orden_del_reporte",
    lambda t: dims.items(t).select("LINEA", "ARTICULO", "ARTICULO_ID").orderBy("LINEA", "ARTICULO", "ARTICULO_ID"),
    f"""{ctes('dim_articulos dim_lineas')} SELECT l.NOMBRE AS LINEA, a.NOMBRE AS ARTICULO, a.ARTICULO_ID FROM dim_articulos a
LEFT JOIN dim_lineas l ON l.LINEA_ARTICULO_ID = a.LINEA_ARTICULO_ID ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3""",
)
both(
    "O2_ultimo_registro",
    lambda t: t["_etl_sync_state"].orderBy(F.col("last_run_at").desc(), "table_name").limit(1),
    f"{ctes('_etl_sync_state')} SELECT * FROM _etl_sync_state ORDER BY last_run_at DESC, table_name LIMIT 1",
)
both(
    "O3_reglas_en_orden",
    lambda t: good_rules(t["textos_reglas"]).select("ORDEN", "PATRON"),
    f"SELECT ORDEN, PATRON FROM ({SQL['S4_reglas']}) r ORDER BY ORDEN",
)
both(
    "U1_union_de_meses",
    lambda t: union_all([t[V].filter(F.month("FECHA") == m).select(*SALE, "UNIDADES") for m in range(1, 13)]),
    sales_where("TRUE"),
)

# --- scalar functions ---
both(
    "FN_fechas",
    lambda t: t["ventas_documentos"].select(
        "DOCTO_VE_ID", month(F.col("FECHA")).alias("MES"), F.add_months("FECHA", -1).alias("MES_MENOS"), F.date_sub("FECHA", 90).alias("DIA_MENOS"),
        days_between(day(AS_OF), F.col("FECHA")).alias("DIAS"), F.date_format("FECHA", "yyyy-MM").alias("TEXTO"),
        F.to_date(F.concat(F.date_format("FECHA", "yyyy-MM"), F.lit("-01"))).alias("DESDE_TEXTO"),
    ),
    f"""{ctes('ventas_documentos')} SELECT DOCTO_VE_ID, {MES} AS MES, CAST(FECHA - INTERVAL 1 MONTH AS DATE) AS MES_MENOS, CAST(FECHA - 90 AS DATE) AS DIA_MENOS,
  date_diff('day', FECHA, {DAY0}) AS DIAS, strftime(FECHA, '%Y-%m') AS TEXTO, {MES} AS DESDE_TEXTO FROM ventas_documentos""",
)
both(
    "FN_horas",
    lambda t: t["_etl_sync_state"].select(
        "table_name", "last_run_at", F.timestamp_diff("HOUR", F.col("last_run_at"), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")).alias("horas")),
    f"""{ctes('_etl_sync_state')} SELECT table_name, last_run_at, date_sub('hour', last_run_at, TIMESTAMP '2024-01-31 00:00:00') AS horas FROM _etl_sync_state""",
)
both(
    "FN_texto",
    lambda t: t["dim_articulo_claves"].select(
        "CLAVE_ARTICULO_ID", F.upper(strip(F.col("ROL"))).alias("ROL"), strip(F.col("CLAVE_ARTICULO")).alias("CLAVE"),
        F.regexp_replace(F.concat_ws(" ", "ROL", "CLAVE_ARTICULO"), "[^A-Za-z0-9_-]", "").alias("LIMPIO"), strip(F.col("CLAVE_ARTICULO")).rlike(catalog.BARCODE).alias("ES_BARRAS")),
    f"""{ctes('dim_articulo_claves')} SELECT CLAVE_ARTICULO_ID, upper(trim(ROL)) AS ROL, trim(CLAVE_ARTICULO) AS CLAVE,
  regexp_replace(ROL || ' ' || CLAVE_ARTICULO, '[^A-Za-z0-9_-]', '', 'g') AS LIMPIO, regexp_full_match(trim(CLAVE_ARTICULO), '[0-9]{{12,14}}') AS ES_BARRAS
FROM dim_articulo_claves""",
)
both(
    "FN_division_segura",
    lambda t: t[V].select(*SALE, ratio(F.col("UTILIDAD"), F.col("IMPORTE_NETO") * (F.col("ARTICULO_ID") % 3)).alias("RAZON")),
    f"""{ctes(V)}, g AS (SELECT *, IMPORTE_NETO * (ARTICULO_ID % 3) AS b FROM {V}) SELECT {SALE_COLS}, {div9('UTILIDAD', 'b')} AS RAZON FROM g""",
)
