"""Table descriptors: columns, grain, load strategy, partitioning, retention."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FULL_REFRESH = "full_refresh"
UPSERT = "upsert"
REPLACE_RANGE = "replace_range"
REPLACE_MONTHS = "replace_months"
SNAPSHOT = "snapshot"
APPEND = "append"
ROLLUP = "rollup"


@dataclass(frozen=True)
class TableSpec:
    """One warehouse table. ``ddl`` lists its columns; it is None where column types are inferred."""

    name: str
    ddl: str | None
    load: str = FULL_REFRESH
    key: str = ""
    partition_by: str = ""
    cluster_by: tuple[str, ...] = ()
    retention_days: int | None = None
    chunk_days: int = 7
    whole_chunk: bool = False  # the source answers in one page; has_more means truncated

    @cached_property
    def schema(self) -> T.StructType | None:
        """The columns as Spark reads the list; asked for when a session is there."""
        return None if self.ddl is None else T.StructType.fromDDL(self.ddl)

    @property
    def required(self) -> list[str]:
        return [] if self.schema is None else [f.name for f in self.schema if not f.nullable]


META = "EMPRESA STRING NOT NULL, _synced_at TIMESTAMP NOT NULL"


def _spec(name: str, ddl: str | None, meta: bool = True, **kw) -> TableSpec:
    return TableSpec(name, f"{ddl}, {META}" if ddl is not None and meta else ddl, **kw)


FACT_RETENTION_DAYS = 1100
SNAPSHOT_RETENTION_DAYS = 400

# Column names and types of the source system.
CATALOGS = (
    _spec(
        "dim_clientes",
        "CLIENTE_ID BIGINT NOT NULL, NOMBRE STRING, ESTATUS STRING, CAUSA_SUSP STRING, FECHA_SUSP DATE, VENDEDOR_ID BIGINT, "
        "COBRADOR_ID BIGINT, TIPO_CLIENTE_ID BIGINT, ZONA_CLIENTE_ID BIGINT, COND_PAGO_ID BIGINT, MONEDA_ID BIGINT, "
        "PRECIO_EMPRESA_ID BIGINT, LIMITE_CREDITO DECIMAL(38,9), CONTACTO1 STRING, FECHA_HORA_CREACION TIMESTAMP_NTZ, "
        "FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ",
    ),
    _spec(
        "dim_articulos",
        "ARTICULO_ID BIGINT NOT NULL, NOMBRE STRING, ESTATUS STRING, CAUSA_SUSP STRING, FECHA_SUSP DATE, "
        "LINEA_ARTICULO_ID BIGINT, UNIDAD_VENTA STRING, UNIDAD_COMPRA STRING, CONTENIDO_UNIDAD_COMPRA DECIMAL(38,9), "
        "PESO_UNITARIO DECIMAL(38,9), ES_ALMACENABLE STRING, ES_JUEGO STRING, ES_IMPORTADO STRING, ES_PRECIO_VARIABLE STRING, "
        "DIAS_GARANTIA BIGINT, FECHA_HORA_CREACION TIMESTAMP_NTZ, FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ",
    ),
    _spec(
        "dim_proveedores",
        "PROVEEDOR_ID BIGINT NOT NULL, NOMBRE STRING, ESTATUS STRING, RFC_CURP STRING, TIPO_PROV_ID BIGINT, "
        "COND_PAGO_ID BIGINT, MONEDA_ID BIGINT, CIUDAD_ID BIGINT, ESTADO_ID BIGINT, PAIS_ID BIGINT, "
        "LIMITE_CREDITO DECIMAL(38,9), EMAIL STRING, TELEFONO1 STRING, CONTACTO1 STRING, EXTRANJERO STRING, "
        "FECHA_HORA_CREACION TIMESTAMP_NTZ, FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ",
    ),
    _spec(
        "dim_almacenes",
        "ALMACEN_ID BIGINT NOT NULL, NOMBRE STRING, NOMBRE_ABREV STRING, ES_PPAL STRING, ES_PREDET STRING, OCULTO STRING, "
        "POBLACION STRING, CIUDAD STRING, ESTADO STRING",
    ),
    _spec("dim_vendedores", "VENDEDOR_ID BIGINT NOT NULL, NOMBRE STRING, ES_PREDET STRING, OCULTO STRING"),
    _spec("dim_lineas", "LINEA_ARTICULO_ID BIGINT NOT NULL, NOMBRE STRING, CLAVE STRING, GRUPO_LINEA_ID BIGINT, ES_PREDET STRING, OCULTO STRING"),
)

AUX_CATALOGS = tuple(
    _spec(name, None, whole_chunk=True)
    for name in ("dim_tipos_clientes", "dim_zonas_clientes", "dim_sucursales", "dim_precios_empresa")
)

ITEM_SUPPLIERS = _spec(
    "dim_articulo_proveedor",
    "PRECIO_COMPRA_ID BIGINT NOT NULL, ARTICULO_ID BIGINT NOT NULL, PROVEEDOR_ID BIGINT NOT NULL, ES_PROV_PREDET BOOLEAN, "
    "PRIORIDAD_COMPRA STRING, CLAVE_ART_PROV STRING, UNIDAD_COMPRA STRING, CONTENIDO_UNIDAD_COMPRA DECIMAL(38,9), "
    "UNIDADES_MIN_UCOM DECIMAL(38,9), FECHA_PRECIO_ULT_COMPRA DATE, DIAS_ENTREGA_PROM DECIMAL(38,9), "
    "TOT_DIAS_ENTREGA DECIMAL(38,9), NUM_COMPRAS BIGINT, FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ",
)

ITEM_CODES = _spec(
    "dim_articulo_claves",
    "CLAVE_ARTICULO_ID BIGINT NOT NULL, ARTICULO_ID BIGINT NOT NULL, ROL_CLAVE_ART_ID BIGINT, ROL STRING, ES_PPAL STRING, "
    "ES_GTIN STRING, CLAVE_ARTICULO STRING, CONTENIDO_EMPAQUE DECIMAL(38,9)",
    cluster_by=("ARTICULO_ID",),
)

CHANNEL_RULES = _spec("dim_formato_venta", "ORDEN BIGINT NOT NULL, PATRON STRING NOT NULL, FORMATO STRING NOT NULL, INCLUIR BOOLEAN NOT NULL")

SALES_DOCS = _spec(
    "ventas_documentos",
    "DOCTO_VE_ID BIGINT NOT NULL, TIPO_DOCTO STRING, SUBTIPO_DOCTO STRING, SUCURSAL_ID BIGINT, FOLIO STRING, "
    "FECHA DATE NOT NULL, HORA STRING, CLIENTE_ID BIGINT, CLAVE_CLIENTE STRING, CLIENTE_NOMBRE STRING, DIR_CLI_ID BIGINT, "
    "ALMACEN_ID BIGINT, VENDEDOR_ID BIGINT, MONEDA_ID BIGINT, TIPO_CAMBIO DECIMAL(38,9), ESTATUS STRING, APLICADO STRING, "
    "TIPO_DSCTO STRING, DSCTO_PCTJE DECIMAL(38,9), DSCTO_IMPORTE DECIMAL(38,9), IMPORTE_NETO DECIMAL(38,9), "
    "FLETES DECIMAL(38,9), OTROS_CARGOS DECIMAL(38,9), TOTAL_IMPUESTOS DECIMAL(38,9), TOTAL_RETENCIONES DECIMAL(38,9), "
    "TOTAL_ANTICIPOS DECIMAL(38,9), IMPORTE_COBRO DECIMAL(38,9), COND_PAGO_ID BIGINT, VIA_EMBARQUE_ID BIGINT, "
    "PCTJE_COMIS DECIMAL(38,9), ORDEN_COMPRA STRING, FECHA_ORDEN_COMPRA DATE, DESCRIPCION STRING, SISTEMA_ORIGEN STRING, "
    "FORMA_EMITIDA STRING, ES_CFD STRING, METODO_PAGO_SAT STRING, USO_CFDI STRING, CFDI_FACT_DEVUELTA_ID BIGINT, "
    "USUARIO_CREADOR STRING, FECHA_HORA_CREACION TIMESTAMP_NTZ, USUARIO_ULT_MODIF STRING, FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ, "
    "USUARIO_CANCELACION STRING, FECHA_HORA_CANCELACION TIMESTAMP_NTZ",
    load=UPSERT,
    key="DOCTO_VE_ID",
    partition_by="FECHA",
    cluster_by=("TIPO_DOCTO", "CLIENTE_ID"),
    retention_days=FACT_RETENTION_DAYS,
    chunk_days=31,
)

SALES = _spec(
    "fact_ventas_articulo",
    "DOCTO_VE_ID BIGINT NOT NULL, TIPO_DOCTO STRING, FOLIO STRING, FECHA DATE NOT NULL, ESTATUS STRING, CLIENTE_ID BIGINT, "
    "VENDEDOR_ID BIGINT, SUCURSAL_ID BIGINT, ALMACEN_ID BIGINT NOT NULL, ARTICULO_ID BIGINT NOT NULL, SIGNO DECIMAL(38,9), "
    "UNIDADES DECIMAL(38,9), IMPORTE_NETO DECIMAL(38,9), COSTO DECIMAL(38,9), UTILIDAD DECIMAL(38,9), IMPUESTOS DECIMAL(38,9), "
    "IMPORTE_TOTAL DECIMAL(38,9), MONEDA_ID BIGINT, TIPO_CAMBIO DECIMAL(38,9), FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ",
    load=REPLACE_RANGE,
    partition_by="FECHA",
    cluster_by=("ARTICULO_ID", "ALMACEN_ID"),
    retention_days=FACT_RETENTION_DAYS,
    chunk_days=7,
    whole_chunk=True,
)

PURCHASES = _spec(
    "fact_compras_partidas",
    "DOCTO_CM_DET_ID BIGINT NOT NULL, DOCTO_CM_ID BIGINT NOT NULL, TIPO_DOCTO STRING, FOLIO STRING, FECHA DATE NOT NULL, "
    "ESTATUS STRING, APLICADO STRING, PROVEEDOR_ID BIGINT, ALMACEN_ID BIGINT, SUCURSAL_ID BIGINT, FOLIO_PROV STRING, "
    "MONEDA_ID BIGINT, TIPO_CAMBIO DECIMAL(38,9), FECHA_HORA_ULT_MODIF TIMESTAMP_NTZ, ARTICULO_ID BIGINT, "
    "CLAVE_ARTICULO STRING, POSICION BIGINT, UMED STRING, CONTENIDO_UMED DECIMAL(38,9), UNIDADES DECIMAL(38,9), "
    "UNIDADES_A_REC DECIMAL(38,9), UNIDADES_REC_DEV DECIMAL(38,9), PRECIO_UNITARIO DECIMAL(38,9), "
    "PRECIO_TOTAL_NETO DECIMAL(38,9), PCTJE_DSCTO DECIMAL(38,9), DSCTO_ART DECIMAL(38,9), DSCTO_EXTRA DECIMAL(38,9)",
    load=REPLACE_RANGE,
    partition_by="FECHA",
    cluster_by=("PROVEEDOR_ID", "ARTICULO_ID"),
    retention_days=FACT_RETENTION_DAYS,
    chunk_days=31,
)

BALANCES = _spec(
    "fact_saldos_mensuales",
    "PERIODO DATE NOT NULL, ANO BIGINT NOT NULL, MES BIGINT NOT NULL, ULTIMO_DIA BIGINT, ARTICULO_ID BIGINT NOT NULL, "
    "ALMACEN_ID BIGINT NOT NULL, ENTRADAS_UNIDADES DECIMAL(38,9), SALIDAS_UNIDADES DECIMAL(38,9), ENTRADAS_COSTO DECIMAL(38,9), "
    "SALIDAS_COSTO DECIMAL(38,9), ES_SALDO_INICIAL BOOLEAN NOT NULL",
    load=REPLACE_MONTHS,
    partition_by="PERIODO",  # always a first of month: one folder per month, never expires
    cluster_by=("ARTICULO_ID", "ALMACEN_ID"),
    whole_chunk=True,
)

STOCK = _spec(
    "inventario_existencias",
    "_snapshot_date DATE NOT NULL, ARTICULO_ID BIGINT NOT NULL, ALMACEN_ID BIGINT NOT NULL, EXISTENCIA DECIMAL(38,9), "
    "COSTO DECIMAL(38,9)",
    load=SNAPSHOT,
    partition_by="_snapshot_date",
    cluster_by=("ALMACEN_ID",),
    retention_days=SNAPSHOT_RETENTION_DAYS,
    whole_chunk=True,
)

SYNC_LOG = _spec(
    "_etl_sync_state",
    "table_name STRING NOT NULL, last_sync_date DATE NOT NULL, last_run_at TIMESTAMP NOT NULL, records_synced BIGINT NOT NULL, "
    "status STRING NOT NULL",
    meta=False,
    load=APPEND,
)

FACTS = (SALES, PURCHASES)
ALL_TABLES = (
    *CATALOGS, *AUX_CATALOGS, ITEM_SUPPLIERS, ITEM_CODES, CHANNEL_RULES, SALES_DOCS, *FACTS, BALANCES, STOCK, SYNC_LOG,
)
SPECS = {s.name: s for s in ALL_TABLES}

# What is kept of facts, by month or year (see operators/rollups.py); the partition is the first day of it.
LAST_SALES = _spec(
    "ultimas_ventas_mes",
    "MES DATE NOT NULL, EMPRESA STRING NOT NULL, ARTICULO_ID BIGINT, ALMACEN_ID BIGINT, ULTIMA_VENTA DATE",
    meta=False, load=ROLLUP, partition_by="MES", cluster_by=("ARTICULO_ID", "ALMACEN_ID"),
)
LAST_PURCHASES = _spec(
    "ultimas_compras_mes",
    "MES DATE NOT NULL, EMPRESA STRING NOT NULL, ARTICULO_ID BIGINT, ULTIMA_COMPRA DATE",
    meta=False, load=ROLLUP, partition_by="MES", cluster_by=("ARTICULO_ID",),
)
YEAR_BALANCES = _spec(
    "saldos_por_ano",
    "DESDE DATE NOT NULL, EMPRESA STRING NOT NULL, ARTICULO_ID BIGINT, ALMACEN_ID BIGINT, UNIDADES DECIMAL(38,9), COSTO DECIMAL(38,9)",
    meta=False, load=ROLLUP, partition_by="DESDE", cluster_by=("ARTICULO_ID", "ALMACEN_ID"),
)
#: Rollup -> the table it is kept of.
KEPT_OF = {LAST_SALES.name: SALES.name, LAST_PURCHASES.name: PURCHASES.name, YEAR_BALANCES.name: BALANCES.name}


class Tables(Mapping[str, DataFrame]):
    """Lazy name -> DataFrame mapping: a plan only builds the inputs it asks for."""

    def __init__(self, make: Callable[[str], DataFrame], names: tuple[str, ...] = tuple(SPECS)):
        self._make, self._names, self._made = make, names, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def replacing(self, **frames: DataFrame) -> "Tables":
        """The same tables with some of them swapped, e.g. facts cut down to one supplier.

        What is kept of a table that is swapped goes, unless it is swapped as well.
        """
        names = [n for n in self._names if n in frames or KEPT_OF.get(n) not in frames]
        return Tables(lambda name: frames[name] if name in frames else self[name], (*names, *[n for n in frames if n not in names]))
