"""V06 current inventory, V07 month-end series, V10 idle items."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import day, days_between, is_invoice, is_receipt, month, not_cancelled, ratio
from ..model import LAST_PURCHASES, LAST_SALES, YEAR_BALANCES, Tables
from .dims import ITEM, with_item_and_warehouse

STOCK_KEY = ["EMPRESA", "ARTICULO_ID", "ALMACEN_ID"]


def latest_snapshot(t: Tables, only_items: DataFrame | None = None) -> DataFrame:
    """Rows of each company's newest snapshot day.

    The days, one for each company, are scalar subqueries: the oldest of them is known before
    the scan and prunes partitions.
    """
    stock = t["inventario_existencias"]
    newest = stock.groupBy("EMPRESA").agg(F.max("_snapshot_date").alias("d"))
    oldest = newest.agg(F.min("d")).scalar()
    by_company = newest.agg(F.map_from_entries(F.collect_list(F.struct("EMPRESA", "d")))).scalar()
    rows = stock.filter((F.col("_snapshot_date") >= oldest) & (F.col("_snapshot_date") == F.try_element_at(by_company, F.col("EMPRESA"))))
    return rows if only_items is None else rows.join(only_items, ITEM, "left_semi")


def sales_so_far(t: Tables, as_of: date) -> DataFrame:
    """Units of the last 90 days and day of the last sale, per item and warehouse.

    Where the last sales of each month are kept, the sales of those days are all that is read of the fact.
    """
    sales, kept = t["fact_ventas_articulo"], t.get(LAST_SALES.name)
    recent, sold_on = F.col("FECHA") >= F.date_sub(day(as_of), 90), F.when(is_invoice(), F.col("FECHA"))
    if kept is None:
        rows = sales.select(*STOCK_KEY, F.when(recent, F.col("UNIDADES")).alias("VENDIDAS"), sold_on.alias("ULTIMA_VENTA"))
    else:
        rows = sales.filter(recent).select(*STOCK_KEY, F.col("UNIDADES").alias("VENDIDAS"))
        rows = rows.unionByName(kept.select(*STOCK_KEY, "ULTIMA_VENTA"), allowMissingColumns=True)
    return rows.groupBy(*STOCK_KEY).agg(F.sum("VENDIDAS").alias("VENDIDAS"), F.max("ULTIMA_VENTA").alias("ULTIMA_VENTA"))


def last_receipts(t: Tables) -> DataFrame:
    """Day of the last receipt of an item, from what is kept of each month where that is there."""
    rows = t.get(LAST_PURCHASES.name)
    if rows is None:
        rows = t["fact_compras_partidas"].filter(is_receipt() & not_cancelled()).withColumn("ULTIMA_COMPRA", F.col("FECHA"))
    return rows.groupBy(*ITEM).agg(F.max("ULTIMA_COMPRA").alias("ULTIMA_COMPRA"))


def stock_and_movements(t: Tables, as_of: date, only_items: DataFrame | None = None) -> DataFrame:
    """Newest stock per item and warehouse with recent sales and last movements, ids only."""
    if only_items is not None:
        facts = ("fact_ventas_articulo", "fact_compras_partidas", LAST_SALES.name, LAST_PURCHASES.name)
        t = t.replacing(**{f: t[f].join(only_items, ITEM, "left_semi") for f in facts if f in t})
    return (
        latest_snapshot(t, only_items)
        .join(sales_so_far(t, as_of), STOCK_KEY, "left")
        .join(last_receipts(t), ITEM, "left")
        .withColumn("DIAS_SIN_VENTA", days_between(day(as_of), F.col("ULTIMA_VENTA")))
    )


def current_inventory(t: Tables, as_of: date, only_items: DataFrame | None = None) -> DataFrame:
    """Newest stock per item and warehouse with cost, 90-day sales, cover and last movements."""
    units = F.coalesce("VENDIDAS", F.lit(0))
    per_day = ratio(units, F.lit(90))
    return with_item_and_warehouse(stock_and_movements(t, as_of, only_items), t).select(
        "EMPRESA", F.col("_snapshot_date").alias("FECHA_SNAPSHOT"),
        "ARTICULO_ID", "ARTICULO", "ARTICULO_ESTATUS", "LINEA_ARTICULO_ID", "LINEA", "ALMACEN_ID", "ALMACEN",
        "EXISTENCIA", F.col("COSTO").alias("VALOR_COSTO"),
        ratio(F.col("COSTO"), F.col("EXISTENCIA")).alias("COSTO_UNITARIO_PROM"),
        units.alias("UNIDADES_90D"),
        per_day.alias("VENTA_DIARIA_PROM"),
        ratio(F.col("EXISTENCIA"), per_day).alias("DIAS_INVENTARIO"),
        "ULTIMA_VENTA", "DIAS_SIN_VENTA", "ULTIMA_COMPRA",
    )


def idle() -> Column:
    """In stock, and never sold or not in 180 days."""
    unsold = F.col("ULTIMA_VENTA").isNull() | (F.col("DIAS_SIN_VENTA") > 180)
    return (F.col("EXISTENCIA") > 0) & unsold


def idle_items(t: Tables, as_of: date) -> DataFrame:
    """Stock on hand that was never sold or not in 180 days."""
    days = F.col("DIAS_SIN_VENTA")
    age = (
        F.when(F.col("ULTIMA_VENTA").isNull(), "Nunca vendido (3 años)")
        .when(days > 365, "Más de 1 año")
        .when(days > 180, "6 a 12 meses")
        .otherwise("Menos de 6 meses")
    )
    return (
        current_inventory(t, as_of)
        .filter(idle())
        .select(
            "EMPRESA", "ARTICULO_ID", "ARTICULO", "ARTICULO_ESTATUS", "LINEA", "ALMACEN_ID", "ALMACEN",
            "EXISTENCIA", "VALOR_COSTO", "ULTIMA_VENTA", "DIAS_SIN_VENTA", "ULTIMA_COMPRA",
            age.alias("ANTIGUEDAD_SIN_VENTA"),
        )
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def stock_changes(t: Tables, as_of: date, with_sales: bool = True) -> DataFrame:
    """Month-end stock per item and warehouse, one row per month *with* a movement or a sale.

    ``HASTA`` is the last month the row's closing balance stays valid. Balances and sales
    meet by union and one aggregation instead of a join, and the window runs over months
    that were already added up, so its groups hold at most one row per month. Without
    sales, UNIDADES_VENDIDAS is zero and the sales table is not read.
    """
    last_month = F.trunc(day(as_of), "MM")
    balances = t["fact_saldos_mensuales"].filter(F.col("PERIODO") <= last_month).select(
        *STOCK_KEY, "PERIODO", "ENTRADAS_UNIDADES", "SALIDAS_UNIDADES", "ENTRADAS_COSTO", "SALIDAS_COSTO",
        "ES_SALDO_INICIAL", F.lit(True).alias("ES_SALDO"),
    )
    if with_sales:
        sales = t["fact_ventas_articulo"].filter(F.col("FECHA") <= F.last_day(day(as_of))).select(
            *STOCK_KEY, month(F.col("FECHA")).alias("PERIODO"), "UNIDADES", F.lit(False).alias("ES_SALDO")
        )
        both = balances.unionByName(sales, allowMissingColumns=True)
    else:
        both = balances.withColumn("UNIDADES", F.lit(0))
    monthly = (
        both.groupBy(*STOCK_KEY, "PERIODO")
        .agg(
            *[F.sum(c).alias(c) for c in ("ENTRADAS_UNIDADES", "SALIDAS_UNIDADES", "ENTRADAS_COSTO", "SALIDAS_COSTO")],
            F.sum("UNIDADES").alias("UNIDADES_VENDIDAS"),
            F.bool_or("ES_SALDO_INICIAL").alias("ES_SALDO_INICIAL"),
            F.bool_or("ES_SALDO").alias("ES_SALDO"),
        )
    )
    # Dealt by item, for the window and for the lookups by item after it; a group is one row per warehouse and month.
    monthly = monthly.repartition(*ITEM)
    series = Window.partitionBy(*STOCK_KEY).orderBy("PERIODO")
    flows = ("ENTRADAS_UNIDADES", "SALIDAS_UNIDADES", "UNIDADES_VENDIDAS")
    return (
        monthly.withColumns(
            {
                "DESDE": F.min(F.when(F.col("ES_SALDO"), F.col("PERIODO"))).over(series),
                "EXISTENCIA_FIN_MES": F.sum(_or_zero("ENTRADAS_UNIDADES") - _or_zero("SALIDAS_UNIDADES")).over(series),
                "VALOR_COSTO_FIN_MES": F.sum(_or_zero("ENTRADAS_COSTO") - _or_zero("SALIDAS_COSTO")).over(series),
                "HASTA": until_next(series, last_month),
            }
        )
        # The series starts with the first balance; earlier sales have no month to belong to.
        .filter(F.col("DESDE").isNotNull())
        .withColumns({**{c: _or_zero(c) for c in flows}, "ES_SALDO_INICIAL": F.coalesce("ES_SALDO_INICIAL", F.lit(False))})
        .drop("DESDE", "ES_SALDO", "ENTRADAS_COSTO", "SALIDAS_COSTO")
    )


def until_next(series: WindowSpec, last_month: Column) -> Column:
    """Last month before the next row of the series."""
    return F.coalesce(F.add_months(F.lead("PERIODO").over(series), -1), last_month)


def fill_months(changes: DataFrame, quiet: dict[str, Column]) -> DataFrame:
    """A dense monthly series without a join: each row is repeated from PERIODO to HASTA.

    ``quiet`` holds what a column says in the repeated months; other columns (balances,
    names) keep their value. Months are counted from a row's own: a sequence of dates goes by way of instants.
    """
    apart = (F.year("HASTA") - F.year("PERIODO")) * 12 + F.month("HASTA") - F.month("PERIODO")
    more = F.when(F.add_months("PERIODO", apart) > F.col("HASTA"), apart - 1).otherwise(apart)
    dense = changes.withColumn("MES_SERIE", F.explode(F.sequence(F.lit(0), more, F.lit(1))))
    own = F.col("MES_SERIE") == 0
    filled = {c: F.when(own, F.col(c)).otherwise(value) for c, value in quiet.items()}
    return dense.withColumns(filled).withColumn("PERIODO", F.add_months("PERIODO", F.col("MES_SERIE"))).drop("MES_SERIE", "HASTA")


def named_changes(t: Tables, as_of: date) -> DataFrame:
    """``stock_changes`` with names, which are attached before the months are filled in, when there are fewer rows."""
    return turning(with_item_and_warehouse(stock_changes(t, as_of), t))


def turning(changes: DataFrame) -> DataFrame:
    return changes.withColumn("ROTACION_MES", ratio(F.col("UNIDADES_VENDIDAS"), F.col("EXISTENCIA_FIN_MES")))


#: What the series of an item in a warehouse says of a month.
SERIES = ("PERIODO", "EXISTENCIA_FIN_MES", "UNIDADES_VENDIDAS")
_AMOUNTS = SERIES[1:]
#: Amounts of so many digits take 8 bytes in a list, others three times as many.
SHORT_DIGITS = 18
#: The columns that series travel in.
PACKED = ("PERIODO", "HASTA", *_AMOUNTS, *[f"{c}_CORTO" for c in _AMOUNTS])


def packed_series(t: Tables, as_of: date) -> DataFrame:
    """``named_changes`` as one row per item and warehouse, in the lists ``PACKED`` and the last HASTA.

    A row holds one entry per month at most. Where series meet other rows and travel, their names do so once; amounts go in the
    lists of short ones if all of the series are short, exact either way. See ``unpacked``.
    """
    changes = stock_changes(t, as_of)
    kinds = {c: changes.schema[c].dataType for c in _AMOUNTS}
    short = lambda c: F.col(c).isNull() | (F.abs(c) < F.lit(Decimal(10) ** (SHORT_DIGITS - kinds[c].scale)))
    entries = F.sort_array(F.collect_list(F.struct(*SERIES)))
    rows = changes.groupBy(*STOCK_KEY).agg(
        entries.alias("SERIE"), F.max("HASTA").alias("HASTA"), *[F.bool_and(short(c)).alias(f"{c}_CABE") for c in _AMOUNTS]
    )
    lists = {c: F.col("SERIE").getField(c) for c in SERIES}
    cut = {c: lists[c].cast(f"array<decimal({SHORT_DIGITS},{k.scale})>") for c, k in kinds.items()}
    packed = rows.select(
        *STOCK_KEY, "HASTA", lists["PERIODO"].alias("PERIODO"),
        *[F.when(~F.col(f"{c}_CABE"), lists[c]).alias(c) for c in _AMOUNTS],
        *[F.when(F.col(f"{c}_CABE"), cut[c]).alias(f"{c}_CORTO") for c in _AMOUNTS],
    )
    return with_item_and_warehouse(packed, t)


def unpacked(series: DataFrame) -> DataFrame:
    """``packed_series`` as one row per change again."""
    names = [c for c in series.columns if c not in PACKED]
    kinds = {c: f"array<{series.schema[c].dataType.elementType.simpleString()}>" for c in _AMOUNTS}
    amounts = [F.coalesce(F.col(f"{c}_CORTO").cast(kind), F.col(c)).alias(c) for c, kind in kinds.items()]
    # The month before the next entry; the last entry holds until the last month there is.
    until = F.concat(F.transform(F.slice("PERIODO", 2, F.size("PERIODO")), lambda next_: F.add_months(next_, -1)), F.array("HASTA"))
    lists = series.select(*names, "PERIODO", until.alias("HASTA"), *amounts)
    return turning(lists.select(*names, F.inline(F.arrays_zip("PERIODO", "HASTA", *_AMOUNTS))))


def every_month(changes: DataFrame) -> DataFrame:
    """``named_changes`` with the months in between, in which nothing was received or sold."""
    zero = F.lit(0)
    quiet = {
        "ENTRADAS_UNIDADES": zero,
        "SALIDAS_UNIDADES": zero,
        "UNIDADES_VENDIDAS": zero,
        "ES_SALDO_INICIAL": F.lit(False),
        "ROTACION_MES": F.when(F.col("EXISTENCIA_FIN_MES") != 0, zero),
    }
    return fill_months(changes, {c: value for c, value in quiet.items() if c in changes.columns})


def monthly_inventory(t: Tables, as_of: date) -> DataFrame:
    """Every month from an item's first balance to the current one."""
    return every_month(named_changes(t, as_of)).select(
        "EMPRESA", "PERIODO", "ARTICULO_ID", "ARTICULO", "LINEA_ARTICULO_ID", "LINEA", "ALMACEN_ID", "ALMACEN",
        "ENTRADAS_UNIDADES", "SALIDAS_UNIDADES", "EXISTENCIA_FIN_MES", "VALOR_COSTO_FIN_MES", "ES_SALDO_INICIAL",
        "UNIDADES_VENDIDAS", "ROTACION_MES",
    )


def closing_stock(t: Tables, as_of: date, mes: date) -> DataFrame:
    """Month-end stock of one month only: a sum up to it, no series needed.

    Where the years' sums are kept, movements are read of the month's own year alone.
    """
    mes, kept = mes.replace(day=1), t.get(YEAR_BALANCES.name)
    new_year = day(mes.replace(month=1))
    rows = t["fact_saldos_mensuales"].filter(F.col("PERIODO") <= day(mes))
    if kept is not None:
        rows = rows.filter(F.col("PERIODO") >= new_year)
    rows = rows.select(
        *STOCK_KEY,
        (_or_zero("ENTRADAS_UNIDADES") - _or_zero("SALIDAS_UNIDADES")).alias("UNIDADES"),
        (_or_zero("ENTRADAS_COSTO") - _or_zero("SALIDAS_COSTO")).alias("COSTO"),
    )
    if kept is not None:
        rows = rows.unionByName(kept.filter(F.col("DESDE") < new_year).select(*STOCK_KEY, "UNIDADES", "COSTO"))
    return (
        rows.filter(F.lit(mes <= as_of.replace(day=1)))
        .groupBy(*STOCK_KEY)
        .agg(F.sum("UNIDADES").alias("EXISTENCIA_FIN_MES"), F.sum("COSTO").alias("VALOR_COSTO_FIN_MES"))
        .withColumn("PERIODO", day(mes))
    )
