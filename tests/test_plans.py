"""What the plans must look like to hold at scale."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.queries import PLANS
from checks.tables import AS_OF, model_tables
from tianguis import model
from tianguis.operators.store import Store
from tianguis.plans import inventory, market
from tianguis.sources.typing import type_rows

from helpers import SF_DIR, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_nested_loops_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    python = ("BatchEvalPython", "FlatMapGroups", "MapInPandas", "ArrowEvalPython")
    if not name.startswith("S4"):  # rule patterns are compiled in Arrow batches
        assert not any(p in text for p in python)


def test_month_series_needs_two_shuffles_and_no_join(spark):
    text = plan(inventory.fill_months(inventory.stock_changes(model_tables(spark, SF_DIR), AS_OF), {}))
    own = text[: text.index("Union")]
    assert own.count("Exchange") == 2 and "Join" not in own


@pytest.mark.parametrize("name", ["V05_margen_linea_mes", "V13_iscam_ventas_mensual", "R1_ventas_zona"])
def test_large_dimensions_give_the_same_rows_after_summing_first(spark, name):
    def run():
        df = PLANS[name](model_tables(spark, SF_DIR))
        return rows(df.select(*sorted(df.columns))), plan(df).count("Exchange hashpartitioning")

    small, shuffles = run()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large, more_shuffles = run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert large == small and more_shuffles > shuffles


def test_narrow_scans(spark):
    text = plan(PLANS["V05_margen_linea_mes"](model_tables(spark, SF_DIR)))
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_linenumber" not in lineitem and "l_tax" not in lineitem and "l_shipdate" not in lineitem


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Some of the model tables, written the way the loads write them."""
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    t = model_tables(spark, SF_DIR)
    at = F.lit("2001-08-01 03:00:00").cast("timestamp")
    for name, start, end in (
        ("fact_ventas_articulo", date(2001, 6, 1), date(2001, 8, 1)),
        ("inventario_existencias", date(2001, 7, 31), date(2001, 8, 1)),
    ):
        spec = model.SPECS[name]
        rows = type_rows(t[name].withColumn("_synced_at", at), spec.schema)
        store.replace_range(spec, rows, start, end)
    for name in ("dim_clientes", "dim_articulos"):
        spec = model.SPECS[name]
        store.full_refresh(spec, type_rows(t[name].withColumn("_synced_at", at), spec.schema))
    return store


def test_a_month_reads_only_its_partitions(stored):
    sales = market.market_sales(stored.tables().replacing(
        dim_tipos_clientes=stored.spark.createDataFrame([], "EMPRESA string, TIPO_CLIENTE_ID long, NOMBRE string")), date(2001, 7, 1))
    scan = next(line for line in plan(sales).splitlines() if "FileScan" in line and "UNIDADES" in line)
    assert "PartitionFilters: [isnotnull(FECHA" in scan and "2001-07-01" in scan and "COSTO" not in scan
    assert sales.count() > 0


def test_newest_snapshot_reads_only_its_partition(stored):
    latest = inventory.latest_snapshot(stored.tables())
    assert {r[0] for r in latest.select("_snapshot_date").distinct().collect()} == {date(2001, 8, 1)}
    assert "PartitionFilters: [isnotnull(_snapshot_date" in plan(latest)


def test_clustered_files(stored):
    """Rows of a file are sorted by item, so row-group statistics can skip; small days are one file."""
    rows = stored.read(model.SALES).select("FECHA", F.input_file_name().alias("f"), "ARTICULO_ID").collect()
    by_file, files_of_day = {}, {}
    for r in rows:
        by_file.setdefault(r.f, []).append(r.ARTICULO_ID)
        files_of_day.setdefault(r.FECHA, set()).add(r.f)
    assert all(items == sorted(items) for items in by_file.values())
    assert {len(f) for f in files_of_day.values()} == {1}
