"""The given tables seen as the retail model.

One SQL text per model table, in the dialect Spark and DuckDB share: Spark builds its
inputs from it and the oracle puts the same text in front of its own query.
"""

from __future__ import annotations

import re
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tianguis.model import Tables

AS_OF = date(2001, 8, 1)  # last order date
AS_OF_TS = datetime(2024, 1, 31)  # events end the day before
COMPANY = "E1"

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

MODEL: dict[str, str] = {}

MODEL["fact_ventas_articulo"] = """
SELECT 'E1' AS EMPRESA, DOCTO_VE_ID, TIPO_DOCTO, FECHA, CLIENTE_ID, VENDEDOR_ID, ALMACEN_ID, ARTICULO_ID,
  CAST(sg * q AS DECIMAL(14,2)) AS UNIDADES,
  CAST(sg * (p * (1 - d)) AS DECIMAL(18,4)) AS IMPORTE_NETO,
  CAST(sg * (p * 0.7) AS DECIMAL(18,4)) AS COSTO,
  CAST(sg * (p * (0.3 - d)) AS DECIMAL(18,4)) AS UTILIDAD,
  CASE WHEN FECHA >= DATE '1996-01-01' THEN CAST(sg * (p * (1 - d) * x) AS DECIMAL(18,6)) END AS IMPUESTOS,
  CASE WHEN FECHA >= DATE '1996-01-01' THEN CAST(sg * (p * (1 - d) * (1 + x)) AS DECIMAL(18,6)) END AS IMPORTE_TOTAL
FROM (
  SELECT CAST(l_orderkey * 2 + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS DOCTO_VE_ID,
    CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'F' END AS TIPO_DOCTO,
    CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sg,
    CAST(o_orderdate AS DATE) AS FECHA,
    o_custkey AS CLIENTE_ID, CAST(o_custkey % 27 AS BIGINT) AS VENDEDOR_ID,
    CAST(l_suppkey % 5 AS BIGINT) AS ALMACEN_ID, l_partkey AS ARTICULO_ID,
    CAST(l_quantity AS DECIMAL(12,2)) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p,
    CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS x
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_custkey % 10 <> 3
) s"""

MODEL["fact_compras_partidas"] = """
SELECT 'E1' AS EMPRESA, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS DOCTO_CM_DET_ID, l_orderkey AS DOCTO_CM_ID,
  CASE WHEN l_returnflag = 'A' THEN 'D' ELSE 'C' END AS TIPO_DOCTO,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'C' ELSE 'N' END AS ESTATUS,
  CAST(l_shipdate AS DATE) AS FECHA, l_suppkey AS PROVEEDOR_ID, CAST(l_suppkey % 5 AS BIGINT) AS ALMACEN_ID,
  l_partkey AS ARTICULO_ID,
  CAST(l_quantity AS DECIMAL(12,2)) AS UNIDADES,
  l_extendedprice / l_quantity AS PRECIO_UNITARIO,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS PRECIO_TOTAL_NETO
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

_MOVES = """
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS PERIODO, l_partkey AS ARTICULO_ID,
    CAST(l_suppkey % 5 AS BIGINT) AS ALMACEN_ID,
    SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS DECIMAL(12,2)) END) AS ENTRADAS_UNIDADES,
    SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(12,2)) END) AS SALIDAS_UNIDADES,
    SUM(CASE WHEN l_returnflag <> 'A' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END) AS ENTRADAS_COSTO,
    SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END) AS SALIDAS_COSTO,
    FALSE AS ES_SALDO_INICIAL
  FROM lineitem GROUP BY 1, 2, 3"""
_OPENING = " UNION ALL ".join(
    f"""
  SELECT DATE '1994-12-01', p_partkey, CAST({k} AS BIGINT), CAST(100 AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2)),
    CAST(p_retailprice * 100 AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2)), TRUE FROM part WHERE p_partkey % 2 = 0"""
    for k in range(5)
)
MODEL["fact_saldos_mensuales"] = f"SELECT 'E1' AS EMPRESA, s.* FROM ({_MOVES} UNION ALL {_OPENING}) s"

MODEL["inventario_existencias"] = " UNION ALL ".join(
    f"""
SELECT 'E1' AS EMPRESA, DATE '{d}' AS _snapshot_date, l_partkey AS ARTICULO_ID, CAST(l_suppkey % 5 AS BIGINT) AS ALMACEN_ID,
  SUM(CAST(CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END AS DECIMAL(12,2))) AS EXISTENCIA,
  SUM(CAST(CASE WHEN l_returnflag = 'A' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(12,2))) AS COSTO
FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{d}' GROUP BY 1, 2, 3, 4"""
    for d in ("2001-07-31", "2001-08-01")
)

MODEL["ventas_documentos"] = """
SELECT 'E1' AS EMPRESA, o_orderkey AS DOCTO_VE_ID,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'F' WHEN '2' THEN 'R' WHEN '3' THEN 'P' WHEN '4' THEN 'C' ELSE 'D' END AS TIPO_DOCTO,
  CAST(o_orderdate AS DATE) AS FECHA, o_custkey AS CLIENTE_ID, CAST(o_totalprice AS DECIMAL(14,2)) AS IMPORTE_NETO
FROM orders"""

_LINE = "CAST(ascii(substr(p_type, 1, 1)) * 100 + length(p_type) AS BIGINT)"
MODEL["dim_articulos"] = f"""
SELECT 'E1' AS EMPRESA, p_partkey AS ARTICULO_ID, p_name AS NOMBRE, CASE WHEN p_size > 45 THEN 'B' ELSE 'A' END AS ESTATUS,
  {_LINE} AS LINEA_ARTICULO_ID, 'PZA' AS UNIDAD_VENTA
FROM part WHERE p_partkey % 50 <> 7"""

MODEL["dim_lineas"] = f"""
SELECT DISTINCT 'E1' AS EMPRESA, {_LINE} AS LINEA_ARTICULO_ID, p_type AS NOMBRE, CAST(1 AS BIGINT) AS GRUPO_LINEA_ID
FROM part WHERE p_type <> 'PROMO'"""

# One customer type per nation and segment, except that MACHINERY customers of odd nations have none.
_TYPE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN c_nationkey * 10 + 1 WHEN 'BUILDING' THEN c_nationkey * 10 + 2
  WHEN 'FURNITURE' THEN c_nationkey * 10 + 3 WHEN 'HOUSEHOLD' THEN c_nationkey * 10 + 4
  ELSE CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey * 10 + 5 END END"""
MODEL["dim_clientes"] = f"""
SELECT 'E1' AS EMPRESA, c_custkey AS CLIENTE_ID, c_name AS NOMBRE, CASE WHEN c_acctbal < 0 THEN 'B' ELSE 'A' END AS ESTATUS,
  CAST(c_nationkey AS BIGINT) AS VENDEDOR_ID, CAST({_TYPE} AS BIGINT) AS TIPO_CLIENTE_ID
FROM customer"""

MODEL["dim_tipos_clientes"] = f"""
SELECT DISTINCT 'E1' AS EMPRESA, TIPO_CLIENTE_ID,
  CASE TIPO_CLIENTE_ID % 10 WHEN 1 THEN concat('Z-1  MOSTRADOR ', n_name) WHEN 2 THEN concat(' z-7', n_name, '  ')
    WHEN 3 THEN 'Automayoreo ' WHEN 4 THEN concat('Z-9 COBRANZA ', n_name) ELSE concat('SIN REGLA ', n_name) END AS NOMBRE
FROM (SELECT CAST({_TYPE} AS BIGINT) AS TIPO_CLIENTE_ID, c_nationkey FROM customer) c
JOIN nation ON n_nationkey = c_nationkey WHERE TIPO_CLIENTE_ID IS NOT NULL"""

MODEL["dim_formato_venta"] = """
SELECT 'E1' AS EMPRESA, CAST(ORDEN AS BIGINT) AS ORDEN, PATRON, FORMATO, INCLUIR FROM (VALUES
  (10, '^Z-1[ ]*MOSTRADOR', 'Tienda / Cash&Carry', TRUE), (20, '^AUTOMAYOREO', 'Cash&Carry', TRUE),
  (30, 'COBRANZA|FLETES', 'Excluir', FALSE), (40, '^Z-[0-9]+', 'Mayoreo tradicional', TRUE)
) AS r(ORDEN, PATRON, FORMATO, INCLUIR)"""

MODEL["dim_proveedores"] = "SELECT 'E1' AS EMPRESA, s_suppkey AS PROVEEDOR_ID, s_name AS NOMBRE FROM supplier"
MODEL["dim_almacenes"] = "SELECT 'E1' AS EMPRESA, CAST(r_regionkey AS BIGINT) AS ALMACEN_ID, r_name AS NOMBRE FROM region"
MODEL["dim_vendedores"] = "SELECT 'E1' AS EMPRESA, CAST(n_nationkey AS BIGINT) AS VENDEDOR_ID, n_name AS NOMBRE FROM nation"

MODEL["dim_articulo_proveedor"] = """
SELECT DISTINCT 'E1' AS EMPRESA, CAST(l_partkey * 100000 + l_suppkey AS BIGINT) AS PRECIO_COMPRA_ID, l_partkey AS ARTICULO_ID,
  l_suppkey AS PROVEEDOR_ID,
  CASE l_suppkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS ES_PROV_PREDET,
  CASE WHEN l_suppkey % 4 <> 0 THEN CAST(l_suppkey % 4 AS STRING) END AS PRIORIDAD_COMPRA,
  CAST(l_suppkey % 30 AS DECIMAL(9,2)) AS DIAS_ENTREGA_PROM, CAST(l_partkey % 17 AS BIGINT) AS NUM_COMPRAS
FROM lineitem"""

MODEL["dim_articulo_claves"] = """
SELECT 'E1' AS EMPRESA, p_partkey * 10 AS CLAVE_ARTICULO_ID, p_partkey AS ARTICULO_ID, 'Principal' AS ROL, 'S' AS ES_PPAL,
  'N' AS ES_GTIN, concat('A', CAST(p_partkey AS STRING)) AS CLAVE_ARTICULO FROM part WHERE p_partkey % 9 <> 0
UNION ALL SELECT 'E1', p_partkey * 10 + 1, p_partkey, 'Clave alterna ', 'N', 'N', concat('X', CAST(p_partkey AS STRING), ' ')
  FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT 'E1', p_partkey * 10 + 2, p_partkey, 'CLAVE ALTERNA', 'N', NULL, CAST(750000000000 + p_partkey AS STRING)
  FROM part WHERE p_partkey % 4 <> 0
UNION ALL SELECT 'E1', p_partkey * 10 + 3, p_partkey, 'Clave alterna', NULL, 'S',
  concat(' ', CAST(7500000000000 + p_partkey AS STRING)) FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'E1', p_partkey * 10 + 4, p_partkey, 'SKU', 'S', 'N', '   ' FROM part WHERE p_partkey % 3 = 0"""

MODEL["_etl_sync_state"] = """
SELECT event_type AS table_name, CAST(ts AS DATE) AS last_sync_date, ts AS last_run_at,
  CAST(floor(value) AS BIGINT) AS records_synced,
  CASE WHEN user_id % 7 = 0 THEN 'error' ELSE 'success' END AS status
FROM events"""

# Text as a source would send it: padded codes, blanks for "nothing", dates with a time part.
MODEL["textos_documentos"] = """
SELECT concat(' ', CAST(o_orderkey AS STRING)) AS docto_ve_id,
  CASE WHEN o_orderkey % 7 = 0 THEN '   ' ELSE concat(o_orderstatus, '-', CAST(o_custkey AS STRING), '    ') END AS FOLIO,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING) END AS IMPORTE_NETO,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T10:20:30') AS FECHA,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T10:20:30') AS FECHA_HORA_CREACION,
  'x' AS EXTRA
FROM orders"""

# Rule rows with every kind of mistake.
MODEL["textos_reglas"] = """
SELECT CASE WHEN p_partkey % 50 = 1 THEN 'diez' ELSE concat(' ', CAST(p_partkey AS STRING)) END AS ORDEN,
  CASE p_partkey % 30 WHEN 2 THEN '  ' WHEN 3 THEN '(abc' ELSE concat('^', p_name, ' ') END AS patron,
  CASE WHEN p_partkey % 40 = 4 THEN ' ' ELSE p_brand END AS FORMATO,
  CASE p_partkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'No' WHEN 2 THEN ' Sí ' WHEN 3 THEN '' WHEN 4 THEN '1' WHEN 5 THEN 'tal vez' END AS Incluir
FROM part"""


@lru_cache(maxsize=64)
def given_table(spark: SparkSession, path: str) -> DataFrame:
    """The plan of a given table; its files are listed and their footers read once per session."""
    return spark.read.parquet(path)


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared SQL with the given tables standing for their Parquet files."""
    # Only the tables a query names are read, so a plan shows just its own scans.
    used = {g: given_table(spark, f"{sf_dir}/{g}.parquet") for g in GIVEN if re.search(rf"(FROM|JOIN) {g}\b", sql)}
    given = ", ".join(f"{g} AS (SELECT * FROM {{{g}}})" for g in used)
    return spark.sql(f"WITH {given} {sql}", **used) if used else spark.sql(sql)


def model_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(lambda name: spark_sql(spark, sf_dir, MODEL.get(name, f"SELECT * FROM {name}")), (*MODEL, *GIVEN))


def ctes(names: str) -> str:
    """``WITH`` clause of an oracle: the named model tables."""
    return "WITH " + ", ".join(f"{n} AS ({MODEL[n]})" for n in names.split())
