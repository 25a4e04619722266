"""Every registered query that SQL can express gives the rows of its SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import canonical

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(contract.LLM_SQL))
def test_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, map(tuple, df.collect())) == canonical(columns, result.fetchall())
