"""Every registered query gives the rows its SQL gives."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracles import SQL
from checks.queries import QUERIES
from checks.tables import MODEL

from helpers import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    if name not in SQL:
        pytest.skip("rows only")
    assert difference(spark, duck, name, SF_DIR) is None


def test_names_match():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_inputs_have_the_edge_cases_the_queries_need(spark, duck):
    one = lambda sql: duck.execute(sql).fetchall()[0][0]
    assert one(f"SELECT count(*) FROM ({MODEL['fact_compras_partidas']}) WHERE ESTATUS IS NULL") > 0
    assert one(f"SELECT count(*) FROM ({MODEL['fact_ventas_articulo']}) WHERE IMPUESTOS IS NULL") > 0
    assert one(f"SELECT count(*) FROM ({MODEL['dim_articulo_proveedor']}) WHERE ES_PROV_PREDET IS NULL") > 0
