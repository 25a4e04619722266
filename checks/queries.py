"""Registered queries: the engine's plans over the given tables.

``QUERIES[name]`` takes (spark, sf_dir). Decimals become DOUBLE at this edge only, so
both engines of a check hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tianguis.model import Tables
from tianguis.plans import catalog, dashboards, inventory, market, monitoring, purchases, report, sales, suppliers

from .scratch import fresh_folder
from .tables import AS_OF, AS_OF_TS, model_tables

MONTH = date(2000, 5, 1)
SUPPLIER = 3

PLANS: dict[str, Callable[[Tables], DataFrame]] = {}  # as a user calls them, amounts still decimal
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


def register(name: str, plan: Callable[[Tables], DataFrame]) -> None:
    PLANS[name] = plan
    QUERIES[name] = lambda spark, sf_dir: doubles(plan(model_tables(spark, sf_dir)))


register("V01_etl_estado", lambda t: monitoring.load_status(t, AS_OF_TS))
register("V02_ventas_diarias_articulo", sales.daily_item_sales)
register("V03_ventas_cliente_mes", sales.customer_month_sales)
register("V04_clientes_resumen", lambda t: sales.customer_summary(t, AS_OF))
register("V05_margen_linea_mes", sales.line_margin)
register("V06_inventario_actual", lambda t: inventory.current_inventory(t, AS_OF))
register("V07_inventario_mensual", lambda t: inventory.monthly_inventory(t, AS_OF))
register("V08_compras_proveedor_mes", purchases.supplier_month_purchases)
register("V09_ultimo_costo_articulo", purchases.last_item_cost)
register("V10_articulos_sin_movimiento", lambda t: inventory.idle_items(t, AS_OF))
register("V11_articulo_claves", catalog.item_codes)
register("V12_tipos_clientes_formato", catalog.customer_type_channels)
register("V13_iscam_ventas_mensual", market.market_sales)
register("V14_iscam_inventario_mensual", lambda t: market.market_inventory(t, AS_OF))

register("P1_sellout", lambda t: suppliers.sell_out(t, SUPPLIER))
register("P1_sellout_todos", suppliers.sell_out)
register("P2_sellin", lambda t: suppliers.sell_in(t, SUPPLIER))
register("P2_sellin_todos", suppliers.sell_in)
register("P3_inventario_actual", lambda t: suppliers.stock_now(t, AS_OF, SUPPLIER))
register("P3_inventario_actual_todos", lambda t: suppliers.stock_now(t, AS_OF))
register("P4_inventario_mensual_todos", lambda t: suppliers.stock_by_month(t, AS_OF))
register("P4_inventario_mensual", lambda t: suppliers.stock_by_month(t, AS_OF, SUPPLIER))

for _cut in report.Cut:
    register(f"R1_ventas_{_cut.name}", lambda t, c=_cut: report.sales_sheet(t, MONTH, c))
register("R2_inventario", lambda t: report.stock_sheet(t, AS_OF, MONTH))


def _written_summary(t: Tables) -> DataFrame:
    """The summary of a report that was written, as it is read again."""
    base = report.write_report(t, AS_OF, MONTH, fresh_folder(t["dim_articulos"].sparkSession), fmt="parquet")
    read = t["dim_articulos"].sparkSession.read.parquet(f"{base}/resumen")
    return read.withColumnsRenamed({heading: name for name, heading in report.HEADINGS.items()} | {report.Cut.formato.heading: "CORTE"})


register("L11_informe", _written_summary)
register("R3_resumen", lambda t: report.summary_sheet(report.sales_sheet(t, MONTH), report.stock_sheet(t, AS_OF, MONTH)))

register("D1_indicadores", lambda t: dashboards.sales_scorecard(t, date(2000, 1, 1), date(2000, 12, 31)))
register("D1_ventas_mes", dashboards.monthly_sales)
register("D2_top_articulos", lambda t: dashboards.top_items(t, 20))
register("D3_mes_anterior", dashboards.month_over_month)
register("D3_periodo_anterior", lambda t: dashboards.period_over_period(t, date(2000, 3, 10), date(2000, 5, 9)))
register("D4_clientes_segmento", lambda t: dashboards.customers_by_segment(t, AS_OF))
register("D4_vendedor_mes", dashboards.seller_months)
register("D5_inventario_indicadores", lambda t: dashboards.inventory_scorecard(t, AS_OF))
register("D5_inventario_linea_mes", lambda t: dashboards.inventory_by_line(t, AS_OF))
register("D6_sellin_sellout", dashboards.sell_in_against_sell_out)
register("D7_cargas_atrasadas", lambda t: monitoring.stale_loads(t, AS_OF_TS))
register("D8_tasa_devolucion", dashboards.return_rates)
