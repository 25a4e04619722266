"""Edge cases the registered queries cannot show: hand-made rows, expected by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tianguis.functions.columns import ratio, strip
from tianguis.model import SPECS, Tables
from tianguis.operators.aggregates import Distinct, pick_first, pick_last, summarise
from tianguis.plans import catalog, inventory, market, monitoring, purchases, report, sales, suppliers

AS_OF = date(2026, 9, 10)
SHORT = {
    "dim_articulos": "EMPRESA string, ARTICULO_ID long, NOMBRE string, ESTATUS string, LINEA_ARTICULO_ID long, UNIDAD_VENTA string",
    "dim_lineas": "EMPRESA string, LINEA_ARTICULO_ID long, NOMBRE string, GRUPO_LINEA_ID long",
    "dim_almacenes": "EMPRESA string, ALMACEN_ID long, NOMBRE string",
    "dim_clientes": "EMPRESA string, CLIENTE_ID long, NOMBRE string, ESTATUS string, VENDEDOR_ID long, TIPO_CLIENTE_ID long",
    "dim_vendedores": "EMPRESA string, VENDEDOR_ID long, NOMBRE string",
    "dim_proveedores": "EMPRESA string, PROVEEDOR_ID long, NOMBRE string",
    "dim_tipos_clientes": "EMPRESA string, TIPO_CLIENTE_ID long, NOMBRE string",
    "dim_formato_venta": "EMPRESA string, ORDEN long, PATRON string, FORMATO string, INCLUIR boolean",
    "dim_articulo_proveedor": "EMPRESA string, PRECIO_COMPRA_ID long, ARTICULO_ID long, PROVEEDOR_ID long, ES_PROV_PREDET boolean,"
    " PRIORIDAD_COMPRA string, DIAS_ENTREGA_PROM decimal(38,9), NUM_COMPRAS long",
    "dim_articulo_claves": "EMPRESA string, CLAVE_ARTICULO_ID long, ARTICULO_ID long, ROL string, ES_PPAL string, ES_GTIN string, CLAVE_ARTICULO string",
    "fact_ventas_articulo": "EMPRESA string, DOCTO_VE_ID long, TIPO_DOCTO string, FECHA date, CLIENTE_ID long, VENDEDOR_ID long, ALMACEN_ID long,"
    " ARTICULO_ID long, UNIDADES decimal(38,9), IMPORTE_NETO decimal(38,9), COSTO decimal(38,9), UTILIDAD decimal(38,9),"
    " IMPUESTOS decimal(38,9), IMPORTE_TOTAL decimal(38,9)",
    "fact_compras_partidas": "EMPRESA string, DOCTO_CM_DET_ID long, DOCTO_CM_ID long, TIPO_DOCTO string, ESTATUS string, FECHA date,"
    " PROVEEDOR_ID long, ALMACEN_ID long, ARTICULO_ID long, UNIDADES decimal(38,9), PRECIO_UNITARIO decimal(38,9), PRECIO_TOTAL_NETO decimal(38,9)",
    "fact_saldos_mensuales": "EMPRESA string, PERIODO date, ARTICULO_ID long, ALMACEN_ID long, ENTRADAS_UNIDADES decimal(38,9),"
    " SALIDAS_UNIDADES decimal(38,9), ENTRADAS_COSTO decimal(38,9), SALIDAS_COSTO decimal(38,9), ES_SALDO_INICIAL boolean",
    "inventario_existencias": "EMPRESA string, _snapshot_date date, ARTICULO_ID long, ALMACEN_ID long, EXISTENCIA decimal(38,9), COSTO decimal(38,9)",
}
N = lambda v: None if v is None else Decimal(str(v))


@pytest.fixture
def tables(spark):
    def make(**data):
        def frame(name):
            schema = SHORT[name]
            return spark.createDataFrame(data.get(name, []), schema)

        return Tables(frame, tuple(SHORT))

    return make


def sale(doc=1, tipo="F", fecha=AS_OF, cliente=1, item=1, wh=1, units=1, net=10, company="E1"):
    return (company, doc, tipo, fecha, cliente, 1, wh, item, N(units), N(net), N(5), N(5), None, None)


def buy(det=1, doc=1, tipo="C", status="N", fecha=AS_OF, supplier=1, wh=1, item=1, units=1, price=10):
    return ("E1", det, doc, tipo, status, fecha, supplier, wh, item, N(units), N(price), N(price * units) if units else N(0))


def balance(period, item=1, wh=1, units_in=0, units_out=0, opening=False, company="E1"):
    return (company, period, item, wh, N(units_in), N(units_out), N(units_in), N(units_out), opening)


def test_strip_removes_all_white_space(spark):
    df = spark.createDataFrame([("\xa0\t a b　\n",), ("  ",), (None,)], "c string")
    assert [r[0] for r in df.select(strip(F.col("c"))).collect()] == ["a b", "", None]


def test_ratio_has_nine_decimals_and_no_zero_division(spark):
    df = spark.createDataFrame([(N(2), N(3)), (N(-2), N(3)), (N(1), N(0)), (None, N(1))], "a decimal(38,9), b decimal(38,9)")
    out = df.select(ratio(F.col("a"), F.col("b")).alias("r"))
    assert dict(out.dtypes) == {"r": "decimal(38,9)"}
    assert [r[0] for r in out.collect()] == [Decimal("0.666666667"), Decimal("-0.666666667"), None, None]


def test_summarise_equals_plain_distinct_counts_on_a_hot_key(spark):
    df = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS k", "id % 997 AS doc", "CASE WHEN id % 11 = 0 THEN NULL ELSE id % 13 END AS item",
        "CASE id % 4 WHEN 0 THEN 'D' WHEN 1 THEN NULL ELSE 'F' END AS tipo", "CASE WHEN id % 5 <> 0 THEN id END AS v", "id % 7 AS m",
    )
    f = F.col("tipo") == "F"
    for distinct in (
        [Distinct("doc", {"nf": f, "nd": F.col("tipo") == "D"})],
        [Distinct("doc", {"nf": f, "nd": F.col("tipo") == "D"}), Distinct("item", {"ni": None})],
        [],
    ):
        got = summarise(df, ["k"], sums={"s": F.col("v")}, mins={"lo": F.col("m")}, maxs={"hi": F.col("m")}, distinct=distinct)
        want = df.groupBy("k").agg(
            F.sum("v").alias("s"), F.min("m").alias("lo"), F.max("m").alias("hi"),
            F.count_distinct(F.when(f, F.col("doc"))).alias("nf"), F.count_distinct(F.when(F.col("tipo") == "D", F.col("doc"))).alias("nd"),
            F.count_distinct("item").alias("ni"),
        )
        assert rows(got) == rows(want, *got.columns)


def test_picks_follow_null_order(spark):
    df = spark.createDataFrame([(1, "2", 1), (1, None, 9), (1, None, 8), (2, "1", 1)], "k long, p string, id long")
    assert rows(pick_first(df, ["k"], ["p", "id"], ["id"])) == [(1, 8), (2, 1)]
    assert rows(pick_last(df, ["k"], ["p"], ["p", "id"])) == [(1, "2", 1), (2, "1", 1)]


def test_two_companies_with_the_same_ids_stay_apart(tables):
    t = tables(
        fact_saldos_mensuales=[balance(date(2026, 8, 1), units_in=5), balance(date(2026, 8, 1), units_in=7, company="E2")],
        fact_ventas_articulo=[sale(units=2), sale(units=3, company="E2")],
        dim_articulos=[("E1", 1, "uno", "A", None, "PZA"), ("E2", 1, "dos", "A", None, "PZA")],
    )
    out = inventory.monthly_inventory(t, AS_OF)
    assert rows(out, "EMPRESA", "PERIODO", "ARTICULO", "EXISTENCIA_FIN_MES", "UNIDADES_VENDIDAS") == [
        ("E1", date(2026, 8, 1), "uno", 5, 0), ("E1", date(2026, 9, 1), "uno", 5, 2),
        ("E2", date(2026, 8, 1), "dos", 7, 0), ("E2", date(2026, 9, 1), "dos", 7, 3),
    ]
    assert rows(sales.daily_item_sales(t), "EMPRESA", "ARTICULO", "UNIDADES") == [("E1", "uno", 2), ("E2", "dos", 3)]


def test_month_series_fills_gaps_and_ignores_what_lies_outside(tables):
    t = tables(
        fact_saldos_mensuales=[
            balance(date(2026, 5, 1), units_in=10, opening=True), balance(date(2026, 7, 1), units_out=4),
            balance(date(2026, 10, 1), units_in=99), balance(date(2026, 8, 1), item=2, units_in=1),
        ],
        fact_ventas_articulo=[
            sale(fecha=date(2026, 4, 30), units=100), sale(fecha=date(2026, 6, 2), units=3), sale(fecha=date(2026, 10, 1), units=50), sale(item=3),
        ],
    )
    out = rows(inventory.monthly_inventory(t, AS_OF), "ARTICULO_ID", "PERIODO", "ENTRADAS_UNIDADES", "SALIDAS_UNIDADES",
               "EXISTENCIA_FIN_MES", "ES_SALDO_INICIAL", "UNIDADES_VENDIDAS", "ROTACION_MES")
    one = [r[1:] for r in out if r[0] == 1]
    assert one == [
        (date(2026, 5, 1), 10, 0, 10, True, 0, 0), (date(2026, 6, 1), 0, 0, 10, False, 3, Decimal("0.3")),
        (date(2026, 7, 1), 0, 4, 6, False, 0, 0), (date(2026, 8, 1), 0, 0, 6, False, 0, 0), (date(2026, 9, 1), 0, 0, 6, False, 0, 0),
    ]
    assert [r[1] for r in out if r[0] == 2] == [date(2026, 8, 1), date(2026, 9, 1)]
    assert {r[0] for r in out} == {1, 2}  # sales alone start no series


def test_one_month_of_stock_equals_that_month_of_the_series(tables):
    t = tables(fact_saldos_mensuales=[balance(date(2026, 5, 1), units_in=10), balance(date(2026, 7, 1), units_out=4), balance(date(2026, 8, 1), item=2, units_in=1)])
    series = market.market_inventory(t, AS_OF)
    for m in (date(2026, 4, 1), date(2026, 6, 1), date(2026, 7, 1), date(2026, 9, 1), date(2026, 10, 1)):
        assert rows(market.market_inventory(t, AS_OF, m)) == rows(series.filter(F.col("MES") == F.lit(m)))


def test_current_inventory(tables):
    t = tables(
        inventario_existencias=[("E1", date(2026, 9, 9), 1, 1, N(99), N(99)), ("E1", AS_OF, 1, 1, N(9), N(90)), ("E1", AS_OF, 2, 1, N(0), N(0))],
        fact_ventas_articulo=[
            sale(fecha=date(2026, 6, 12), units=90), sale(fecha=date(2026, 6, 11), units=1000), sale(fecha=date(2026, 9, 11), tipo="D", units=-45),
            sale(item=2, tipo="D", units=-1),
        ],
        fact_compras_partidas=[buy(fecha=date(2026, 9, 1)), buy(fecha=date(2026, 9, 5), status=None), buy(fecha=date(2026, 9, 6), status="C"),
                               buy(fecha=date(2026, 9, 7), tipo="D")],
    )
    out = {r.ARTICULO_ID: r for r in inventory.current_inventory(t, AS_OF).collect()}
    a, b = out[1], out[2]
    assert (a.FECHA_SNAPSHOT, a.COSTO_UNITARIO_PROM, a.UNIDADES_90D, a.VENTA_DIARIA_PROM, a.DIAS_INVENTARIO) == (AS_OF, 10, 45, Decimal("0.5"), 18)
    assert (a.ULTIMA_VENTA, a.DIAS_SIN_VENTA, a.ULTIMA_COMPRA) == (date(2026, 6, 12), 90, date(2026, 9, 1))
    assert (b.COSTO_UNITARIO_PROM, b.UNIDADES_90D, b.DIAS_INVENTARIO, b.ULTIMA_VENTA) == (None, -1, 0, None)


def test_idle_items(tables):
    stock = [("E1", AS_OF, i, 1, N(q), N(1)) for i, q in ((1, 5), (2, 5), (3, 5), (4, 0), (5, 5))]
    t = tables(
        inventario_existencias=stock,
        fact_ventas_articulo=[sale(item=1, fecha=date(2025, 9, 9)), sale(item=2, fecha=date(2026, 3, 13)), sale(item=3, fecha=date(2026, 3, 14))],
    )
    assert rows(inventory.idle_items(t, AS_OF), "ARTICULO_ID", "DIAS_SIN_VENTA", "ANTIGUEDAD_SIN_VENTA") == [
        (1, 366, "Más de 1 año"), (2, 181, "6 a 12 meses"), (5, None, "Nunca vendido (3 años)"),
    ]


def test_customer_segments_and_windows(tables):
    fecha = {1: date(2026, 8, 11), 2: date(2026, 8, 10), 3: date(2026, 6, 11), 4: date(2026, 3, 13)}
    t = tables(
        dim_clientes=[("E1", i, f"c{i}", "A", 1, None) for i in range(1, 7)],
        fact_ventas_articulo=[sale(doc=i, cliente=i, fecha=d) for i, d in fecha.items()]
        + [sale(doc=50, cliente=5, tipo="D", fecha=AS_OF, net=-3), sale(doc=11, cliente=1, fecha=date(2025, 9, 10), net=7),
           sale(doc=12, cliente=1, fecha=date(2025, 9, 9), net=4), sale(doc=13, cliente=1, fecha=date(2024, 9, 9), net=1)],
    )
    out = {r.CLIENTE_ID: r for r in sales.customer_summary(t, AS_OF).collect()}
    assert [out[i].SEGMENTO_RECENCIA for i in range(1, 7)] == ["Activo", "En riesgo", "Inactivo", "Perdido", "Sin ventas", "Sin ventas"]
    one = out[1]
    assert (one.IMPORTE_12M, one.FACTURAS_12M, one.MESES_ACTIVOS_12M, one.IMPORTE_12M_ANTERIOR, one.PRIMERA_COMPRA) == (17, 2, 2, 4, date(2024, 9, 9))
    assert (one.TICKET_PROMEDIO_12M, one.CRECIMIENTO_PCT) == (Decimal("8.5"), Decimal("3.25"))
    assert out[5].IMPORTE_12M == -3 and out[5].PRIMERA_COMPRA == AS_OF and out[6].IMPORTE_12M is None


def test_purchases_count_anything_but_a_receipt_as_a_return(tables):
    t = tables(fact_compras_partidas=[buy(doc=1, units=5), buy(doc=2, tipo="D", units=1), buy(doc=3, tipo=None, units=1), buy(doc=4, status="C", units=50)])
    out = purchases.supplier_month_purchases(t).first()
    assert (out.UNIDADES, out.COSTO_UNITARIO_PROM, out.COMPRAS, out.DEVOLUCIONES) == (3, 10, 1, 1)
    assert suppliers.sell_in(t, 1).first().UNIDADES == 3 and suppliers.sell_in(t, 2).count() == 0


def test_last_cost_and_default_supplier(tables):
    t = tables(
        dim_articulos=[("E1", 1, "uno", "A", None, "PZA"), ("E1", 2, "dos", "A", None, "PZA")],
        fact_compras_partidas=[buy(det=1, price=10), buy(det=2, price=20), buy(det=3, price=30, units=0), buy(det=4, price=40, tipo="D")],
        dim_articulo_proveedor=[
            ("E1", 1, 1, 10, True, "1", N(3), 7), ("E1", 3, 1, 30, True, None, N(5), 8), ("E1", 2, 1, 20, True, None, N(4), 9), ("E1", 0, 1, 40, None, None, N(4), 9)],
        dim_proveedores=[("E1", 20, "veinte"), ("E1", 1, "uno")],
    )
    out = {r.ARTICULO_ID: r for r in purchases.last_item_cost(t).collect()}
    assert (out[1].ULTIMO_COSTO, out[1].PROVEEDOR_ULT_COMPRA, out[1].PROVEEDOR_PREDET_ID, out[1].PROVEEDOR_PREDET, out[1].DIAS_ENTREGA_PROM) == (20, "uno", 20, "veinte", 4)
    assert out[2].ULTIMO_COSTO is None and out[2].PROVEEDOR_PREDET_ID is None


CHANNEL_RULES = [("E1", 10, r"^Z-1\s*MOSTRADOR", "Tienda", True), ("E1", 40, r"^Z-\d+", "Mayoreo", True), ("E1", 30, "COBRANZA|FLETES", "Excluir", False),
                 ("E2", 1, ".", "Otra empresa", True)]
CHANNEL_TYPES = [("E1", 1, "Z-1  Mostrador centro "), ("E1", 2, "z-7 norte"), ("E1", 3, "z-9 cobranza"), ("E1", 4, None), ("E1", 5, "Pacífico")]


@pytest.mark.parametrize("others", [0, 300])
def test_first_rule_wins_whatever_the_number_of_rules(spark, tables, others):
    more = [("E1", 100 + i, f"^NADIE {i}$", "Nunca", True) for i in range(others)]
    t = tables(dim_tipos_clientes=CHANNEL_TYPES, dim_formato_venta=CHANNEL_RULES + more)
    out = catalog.match_channel(t["dim_tipos_clientes"], t["dim_formato_venta"])
    got = {r.TIPO_CLIENTE_ID: r._regla for r in out.collect()}
    assert {k: v and v.FORMATO for k, v in got.items()} == {1: "Tienda", 2: "Mayoreo", 3: "Excluir", 4: None, 5: None}


def test_channel_defaults(tables):
    t = tables(dim_tipos_clientes=CHANNEL_TYPES, dim_formato_venta=CHANNEL_RULES)
    out = {r.TIPO_CLIENTE_ID: r for r in catalog.customer_type_channels(t).collect()}
    assert (out[1].ZONA, out[1].ORDEN_REGLA) == ("Z-1  Mostrador centro", 10)
    assert (out[4].FORMATO, out[4].INCLUIR, out[4].ORDEN_REGLA) == ("Otros", True, None)
    empty = tables(dim_tipos_clientes=CHANNEL_TYPES)
    assert {r.FORMATO for r in catalog.customer_type_channels(empty).collect()} == {"Otros"}


def test_item_codes(tables):
    code = lambda id, item, rol, ppal, gtin, text: ("E1", id, item, rol, ppal, gtin, text)
    t = tables(dim_articulo_claves=[
        code(3, 1, "Principal", "S", "N", "B"), code(2, 1, "Principal", "S", "N", " A "), code(1, 1, "SKU", "S", "N", "  "),
        code(4, 1, " clave alterna", "N", "N", "750000000001"), code(5, 1, "Clave alterna", "N", "S", "7500000000002\n"), code(6, 1, "Clave alterna", "N", "S", "75"),
        code(7, 2, "SKU", "N", "N", "x"), code(8, 3, "SKU", "N", "N", None)])
    assert rows(catalog.item_codes(t)) == [("E1", 1, "A", "7500000000002", "750000000001"), ("E1", 2, None, None, None)]


def test_supplier_extracts_show_no_cost_and_accept_every_default_supplier(tables):
    pairs = [("E1", 1, 1, 10, True, None, None, None), ("E1", 2, 1, 20, True, None, None, None), ("E1", 3, 2, 10, False, None, None, None)]
    t = tables(dim_articulo_proveedor=pairs, fact_ventas_articulo=[sale(item=1), sale(item=2)], fact_saldos_mensuales=[balance(date(2026, 8, 1), units_in=1)],
               inventario_existencias=[("E1", AS_OF, 2, 1, N(1), N(1)), ("E1", date(2026, 9, 1), 1, 1, N(1), N(1))])
    for supplier in (10, 20):
        assert rows(suppliers.sell_out(t, supplier), "ARTICULO_ID", "UNIDADES") == [(1, 1)]
        assert suppliers.stock_by_month(t, AS_OF, supplier).count() == 2
        # Item 1 is not in the newest snapshot of the whole table.
        assert suppliers.stock_now(t, AS_OF, supplier).count() == 0
    assert rows(suppliers.sell_out(t), "PROVEEDOR_ID") == [(10,), (20,)]
    assert rows(suppliers.stock_by_month(t, AS_OF), "PROVEEDOR_ID", "PERIODO")[0] == (10, date(2026, 8, 1))
    for plan in (suppliers.sell_out(t, 10), suppliers.sell_in(t, 10), suppliers.stock_now(t, AS_OF, 10), suppliers.stock_by_month(t, AS_OF, 10)):
        assert not [c for c in plan.columns if "COSTO" in c or "CLIENTE" in c or "UNITARIO" in c or "UTILIDAD" in c]


def test_load_status_counts_whole_hours(spark):
    log = spark.createDataFrame([("t", AS_OF, datetime(2026, 9, 9, 12, 30), 5, "error"), ("t", AS_OF, datetime(2026, 9, 9, 1), 5, "success")],
                                "table_name string, last_sync_date date, last_run_at timestamp_ntz, records_synced long, status string")
    t = Tables(lambda name: log, ("_etl_sync_state",))
    out = monitoring.load_status(t, datetime(2026, 9, 10, 19, 29)).first()
    assert (out.status, out.horas_desde_corrida) == ("error", 30)
    assert monitoring.stale_loads(t, datetime(2026, 9, 10, 19, 29)).count() == 0
    assert monitoring.stale_loads(t, datetime(2026, 9, 10, 19, 30)).count() == 1
    assert monitoring.last_good_date(log, "t").first()[0] == AS_OF and monitoring.last_good_date(log, "x").first()[0] is None


REPORT_SALES = [("Muelle", "K-71", 7, 210, "21.5", "231.5"), ("Muelle", "K-90", 4, 36, "0", 36), ("Ruta sur", "K-71", -3, -90, "-9.25", "-99.25")]


def sheet(spark, data):
    rows_ = [(date(2026, 8, 1), c, k, *[N(x) for x in m]) for c, k, *m in data]
    return spark.createDataFrame(rows_, "MES date, CORTE string, CLAVE_PRINCIPAL string, PIEZAS decimal(38,9), IMPORTE_SIN_IMPUESTOS decimal(38,9),"
                                 " IMPUESTOS decimal(38,9), IMPORTE_CON_IMPUESTOS decimal(38,9)")


def test_report_totals(spark):
    stock = spark.createDataFrame([(N(3), N(30)), (None, N(5))], "EXISTENCIA_FIN_MES decimal(38,9), VALOR_COSTO_FIN_MES decimal(38,9)")
    out = report.summary_sheet(sheet(spark, REPORT_SALES + [(None, "x", 1, 1, 1, 1), ("", "y", 1, 1, 1, 1)]), stock).collect()
    found = [(r.SECCION, r.CORTE, r.RENGLONES, r.PIEZAS, r.IMPORTE_CON_IMPUESTOS) for r in out]
    assert found == [("Ventas", "(sin dato)", 2, 2, 2), ("Ventas", "Muelle", 2, 11, N("267.5")), ("Ventas", "Ruta sur", 1, -3, N("-99.25")),
                     ("Total", "Total", 5, 10, N("170.25")), ("Inventario", None, 2, None, None)]
    assert (out[-1].EXISTENCIA_FIN_MES, out[-1].VALOR_COSTO_FIN_MES) == (3, 35)
    grand = [r for r in report.summary_sheet(sheet(spark, REPORT_SALES), stock).collect() if r.SECCION == "Total"][0]
    assert (grand.PIEZAS, grand.IMPORTE_CON_IMPUESTOS) == (8, N("168.25"))


def test_report_of_an_empty_month_still_has_three_tables(spark, tables, tmp_path):
    base = report.write_report(tables(), AS_OF, date(2026, 8, 15), str(tmp_path), empresa="ALMACENES DEL SUR")
    assert base.endswith("ISCAM_ALMACENESDELSUR_2026-08")
    for name, count in (("ventas", 0), ("inventario", 0), ("resumen", 2)):
        assert spark.read.option("header", "true").csv(f"{base}/{name}").count() == count
    assert report.report_name("", date(2026, 8, 1)) == "ISCAM_EMPRESA_2026-08"
    with pytest.raises(KeyError):
        report.Cut["marca"]


def test_report_filters_company_month_and_excluded_channels(spark, tables, tmp_path):
    t = tables(
        fact_ventas_articulo=[sale(fecha=date(2026, 8, 31)), sale(fecha=date(2026, 9, 1)), sale(fecha=date(2026, 8, 1), company="E2"), sale(cliente=3, fecha=date(2026, 8, 1))],
        dim_clientes=[("E1", 1, "c", "A", 1, 1), ("E1", 3, "d", "A", 1, 3)], dim_tipos_clientes=CHANNEL_TYPES, dim_formato_venta=CHANNEL_RULES,
        fact_saldos_mensuales=[balance(date(2026, 8, 1), units_in=4), balance(date(2026, 8, 1), item=2)],
    )
    assert rows(report.sales_sheet(t, date(2026, 8, 15), report.Cut.formato, "E1"), "CORTE", "PIEZAS") == [("Tienda", 1)]
    assert len(rows(report.sales_sheet(t, date(2026, 8, 15)))) == 2
    assert rows(report.stock_sheet(t, AS_OF, date(2026, 8, 1)), "EXISTENCIA_FIN_MES") == [(4,)]
    base = report.write_report(t, AS_OF, date(2026, 8, 1), str(tmp_path), empresa="E1")
    head = spark.read.option("header", "true").csv(f"{base}/ventas")
    assert head.columns[:3] == ["Mes", "Formato", "Clave"] and head.first()[0] == "2026-08"


def test_the_summary_adds_up_the_sheets_that_were_written(spark, tables, tmp_path, monkeypatch):
    t = tables(
        fact_ventas_articulo=[sale(fecha=date(2026, 8, 31)), sale(fecha=date(2026, 8, 2), item=2)],
        dim_clientes=[("E1", 1, "c", "A", 1, 1)], dim_tipos_clientes=CHANNEL_TYPES, dim_formato_venta=CHANNEL_RULES,
        fact_saldos_mensuales=[balance(date(2026, 8, 1), units_in=4)],
    )
    made, write = [], report._written
    monkeypatch.setattr(report, "_written", lambda df, *rest: made.append(df) or write(df, *rest))
    base = report.write_report(t, AS_OF, date(2026, 8, 1), str(tmp_path), report.Cut.zona)
    assert all(f"{base}/" in f for f in made[2].inputFiles()) and len(made) == 3
    expected = report.summary_sheet(report.sales_sheet(t, date(2026, 8, 1), report.Cut.zona), report.stock_sheet(t, AS_OF, date(2026, 8, 1)))
    assert rows(made[2]) == rows(expected)


def test_every_plan_input_is_a_declared_table():
    assert set(SHORT) <= set(SPECS)
