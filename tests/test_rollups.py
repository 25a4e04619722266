"""What is kept of tables says what the tables say, whatever was loaded since."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tianguis.model import BALANCES, LAST_PURCHASES, LAST_SALES, PURCHASES, SALES, YEAR_BALANCES, TableSpec
from tianguis.operators.rollups import ROLLUPS
from tianguis.operators.store import Store
from tianguis.plans import inventory

AS_OF = date(2026, 4, 20)
FIRST = date(2025, 10, 1)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def typed(spark, spec: TableSpec, data: list[dict]):
    """Rows of a table of which a test says some columns."""
    return spark.createDataFrame([tuple(r.get(n) for n in spec.schema.names) for r in data], nullable(spec))


def nullable(spec: TableSpec):
    return type(spec.schema)([type(f)(f.name, f.dataType, True) for f in spec.schema])


def sold(day: date, item: int, kind: str = "F", units: int = 1) -> dict:
    return dict(EMPRESA="E1", FECHA=day, ARTICULO_ID=item, ALMACEN_ID=item % 2, TIPO_DOCTO=kind, UNIDADES=Decimal(units))


def bought(day: date, item: int, kind: str = "C", status: str | None = "N") -> dict:
    return dict(EMPRESA="E1", FECHA=day, ARTICULO_ID=item, TIPO_DOCTO=kind, ESTATUS=status)


def moved(month: date, item: int, units: int) -> dict:
    return dict(EMPRESA="E1", PERIODO=month, ARTICULO_ID=item, ALMACEN_ID=1, ENTRADAS_UNIDADES=Decimal(units), SALIDAS_COSTO=Decimal(1))


def both_ways(store):
    """Last movements by what is kept, and by the facts alone."""
    t = store.tables()
    plain = t.replacing(**{n: t[n] for n in (SALES.name, PURCHASES.name)})
    assert LAST_SALES.name in t and LAST_SALES.name not in plain
    said = F.col("VENDIDAS").isNotNull() | F.col("ULTIMA_VENTA").isNotNull()
    return [
        (rows(inventory.sales_so_far(x, AS_OF).filter(said)), rows(inventory.last_receipts(x))) for x in (t, plain)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_last_movements_after_any_loads(spark, store, seed):
    """Ranges replaced, emptied and dropped, with and without summing up in between."""
    pick = random.Random(seed)
    day = lambda: FIRST + timedelta(days=pick.randrange(200))
    for _ in range(5):
        start = day()
        end = start + timedelta(days=pick.choice([0, 20, 70]))
        inside = [start + timedelta(days=pick.randrange((end - start).days + 1)) for _ in range(pick.choice([0, 6, 6]))]
        store.replace_range(SALES, typed(spark, SALES, [sold(d, pick.randrange(4), pick.choice("FFD")) for d in inside]), start, end)
        store.replace_range(
            PURCHASES, typed(spark, PURCHASES, [bought(d, pick.randrange(4), pick.choice("CCD"), pick.choice(["N", "C", None])) for d in inside]), start, end
        )
        if pick.random() < 0.5:
            ROLLUPS[LAST_SALES.name].refresh(store)
        kept, plain = both_ways(store)
        assert kept == plain
    store.expire(SALES, FIRST + timedelta(days=1100 + 90))
    kept, plain = both_ways(store)
    assert kept == plain


def test_only_changed_months_are_summed_up_again(spark, store):
    rollup = ROLLUPS[LAST_SALES.name]
    assert rollup.refresh(store) == []
    days = [date(2026, 1, 5), date(2026, 2, 5), date(2026, 3, 5)]
    store.replace_range(SALES, typed(spark, SALES, [sold(d, 1) for d in days]), days[0], days[-1])
    assert rollup.refresh(store) == ["2026-01-01", "2026-02-01", "2026-03-01"] and rollup.refresh(store) == []
    before = store.live(LAST_SALES).folders
    store.replace_range(SALES, typed(spark, SALES, [sold(date(2026, 2, 9), 1)]), date(2026, 2, 1), date(2026, 2, 28))
    assert rollup.refresh(store) == ["2026-02-01"]
    after = store.live(LAST_SALES).folders
    assert {m for m in after if after[m] != before[m]} == {"2026-02-01"}
    assert rows(rollup.read(store), "MES", "ULTIMA_VENTA")[1] == (date(2026, 2, 1), date(2026, 2, 9))
    store.replace_range(SALES, typed(spark, SALES, []), date(2026, 1, 1), date(2026, 1, 31))
    assert rollup.refresh(store) == ["2026-01-01"] and "2026-01-01" not in store.live(LAST_SALES).folders


def scanned(df) -> list[str]:
    return sorted({f.rsplit("/", 2)[-2] for f in df.inputFiles()})


def test_current_stock_reads_ninety_days_of_sales_and_no_purchases(spark, store):
    days = [date(2024, 1, 1) + timedelta(days=90 * i) for i in range(9)] + [AS_OF]
    store.replace_range(SALES, typed(spark, SALES, [sold(d, 1) for d in days]), days[0], days[-1])
    store.replace_range(PURCHASES, typed(spark, PURCHASES, [bought(d, 1) for d in days]), days[0], days[-1])
    for name in (LAST_SALES.name, LAST_PURCHASES.name):
        ROLLUPS[name].refresh(store)
    t = store.tables()
    text = inventory.sales_so_far(t, AS_OF)._jdf.queryExecution().executedPlan().toString()
    facts = [line for line in text.splitlines() if "FileScan" in line and "UNIDADES" in line]
    assert len(facts) == 1 and "PartitionFilters: [isnotnull(FECHA" in facts[0]
    assert all(f.startswith("MES=") for f in scanned(inventory.last_receipts(t)))


def test_stock_of_a_month_reads_its_own_year(spark, store):
    months = [date(y, m, 1) for y in (2024, 2025, 2026) for m in (1, 2, 12)]
    store.replace_range(BALANCES, typed(spark, BALANCES, [moved(m, i, m.month + i) for m in months for i in (1, 2)]), months[0], months[-1])
    t = store.tables()
    plain = t.replacing(**{BALANCES.name: t[BALANCES.name]})
    for again in (False, True):
        if again:
            assert ROLLUPS[YEAR_BALANCES.name].refresh(store) == ["2024-01-01", "2025-01-01", "2026-01-01"]
        for mes in (date(2024, 1, 1), date(2025, 12, 1), date(2026, 2, 1)):
            args = (date(2026, 12, 31), mes)
            assert rows(inventory.closing_stock(store.tables(), *args)) == rows(inventory.closing_stock(plain, *args))
    plan = inventory.closing_stock(store.tables(), date(2026, 12, 31), date(2026, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PERIODO#" in plan and ">= 2026-01-01" in plan
    # A month that is in the future of the reference date has no stock yet.
    assert inventory.closing_stock(store.tables(), date(2026, 1, 31), date(2026, 2, 1)).count() == 0
