from pyspark.sql import types as T

from tianguis.model import ALL_TABLES, BALANCES, META, SALES, SALES_DOCS, SPECS, STOCK


def test_names_are_unique():
    assert len(SPECS) == len(ALL_TABLES)


def test_layout_and_key_columns_exist(spark):
    for spec in ALL_TABLES:
        if spec.schema is None:
            continue
        names = set(spec.schema.names)
        assert {c for c in (spec.partition_by, spec.key, *spec.cluster_by) if c} <= names, spec.name
        if spec.name != "_etl_sync_state":
            assert set(T.StructType.fromDDL(META).names) <= names


def test_column_counts(spark):
    count = {s.name: len(s.schema) - 2 for s in ALL_TABLES if s.schema is not None and s.name != "_etl_sync_state"}
    assert count["dim_clientes"] == 16 and count["dim_articulos"] == 17 and count["ventas_documentos"] == 45
    assert count["fact_ventas_articulo"] == 20 and count["fact_compras_partidas"] == 27
    assert count["fact_saldos_mensuales"] == 11 and count["inventario_existencias"] == 5


def test_retention():
    assert SALES.retention_days == 1100 and SALES_DOCS.retention_days == 1100
    assert STOCK.retention_days == 400 and BALANCES.retention_days is None
