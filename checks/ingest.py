"""Registered queries for sources (S), loads (L) and jobs (J), each next to its SQL."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tianguis import jobs, model
from tianguis.functions.columns import month
from tianguis.model import BALANCES, LAST_PURCHASES, LAST_SALES, PURCHASES, SALES, SALES_DOCS, STOCK, SYNC_LOG, YEAR_BALANCES, TableSpec, Tables
from tianguis.operators.rollups import ROLLUPS
from tianguis.operators.store import Store
from tianguis.plans import inventory
from tianguis.plans.monitoring import last_good_date, last_good_dates
from tianguis.sources.feeds import SALES_FEEDS, month_delta, opening_balance, snapshot_of, tagged_union, union_all
from tianguis.sources.pages import HEADER, chain_faults, read_inferred_pages, read_pages, read_pages_with_defaults, strict
from tianguis.sources.rules import check_rules, good_rules
from tianguis.publication import Publication
from tianguis.sources.typing import finalise, require, type_rows

from .oracles import _MONTHS_BY, _NOW_BY, _SALES_COLS, _SELL_IN, _SELL_OUT, MES, SQL, dbl
from .queries import register
from .scratch import fresh_folder
from .tables import AS_OF, COMPANY, ctes

DOCS = "ventas_documentos"
DOC_COLS = "EMPRESA, DOCTO_VE_ID, TIPO_DOCTO, FECHA, CLIENTE_ID"
SALE_COLS = "EMPRESA, DOCTO_VE_ID, TIPO_DOCTO, FECHA, CLIENTE_ID, VENDEDOR_ID, ALMACEN_ID, ARTICULO_ID"
SALE_AMOUNTS = "UNIDADES IMPORTE_NETO COSTO UTILIDAD IMPUESTOS IMPORTE_TOTAL"
BALANCE_AMOUNTS = "ENTRADAS_UNIDADES SALIDAS_UNIDADES ENTRADAS_COSTO SALIDAS_COSTO"


ddl = T.StructType.fromDDL


def both(name: str, plan, sql: str) -> None:
    register(name, plan)
    SQL[name] = sql


# --- S: sources ---

DOC_SCHEMA = "DOCTO_VE_ID BIGINT NOT NULL, FOLIO STRING, IMPORTE_NETO DECIMAL(38,9), FECHA DATE NOT NULL, FECHA_HORA_CREACION TIMESTAMP_NTZ, CLIENTE_ID BIGINT"
TYPED_DOCS = """SELECT o_orderkey AS DOCTO_VE_ID, CASE WHEN o_orderkey % 7 <> 0 THEN concat(o_orderstatus, '-', o_custkey) END AS FOLIO,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) END AS IMPORTE_NETO, CAST(o_orderdate AS DATE) AS FECHA,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '10 hours 20 minutes 30 seconds' AS FECHA_HORA_CREACION, CAST(NULL AS BIGINT) AS CLIENTE_ID"""


PAGE, ANSWER = 500, 5000  # keys to a page, keys to an answer


def landed_pages(rows: DataFrame, key: str) -> DataFrame:
    """Rows as the pages of answers of several pages each; the cursor of a page is the first key it may hold.

    Rows are dealt by answer once: pages are made and put in order where their answer lies.
    """
    number = F.trim(F.col(key).cast("string")).cast("bigint")
    first = F.floor(number / PAGE) * PAGE
    dealt = rows.select(F.struct(*rows.columns).alias("row"), first.alias("first"), F.floor(first / ANSWER).alias("answer")).repartition("answer")
    pages = dealt.groupBy("answer", "first").agg(F.collect_list("row").alias("data"))
    of_answer = Window.partitionBy("answer").orderBy("first")
    pages = pages.withColumn("next_cursor", F.lead("first").over(of_answer))
    opened = F.row_number().over(of_answer) == 1
    return pages.select(
        "data",
        F.col("next_cursor").isNotNull().alias("has_more"),
        "next_cursor",
        F.col("answer").cast("string").alias("answer"),
        F.when(opened, 0).otherwise(F.col("first")).alias("cursor"),
    )


def written(pages: DataFrame, path: str) -> str:
    """Landed as gzip files, one for each task: names are repeated in every row of the text."""
    pages.select(F.to_json(F.struct(*pages.columns)).alias("value")).write.text(path, compression="gzip")
    return path


def land(rows: DataFrame, key: str, path: str | None = None) -> str:
    """Rows as landed answers; returns their folder."""
    return written(landed_pages(rows, key), path or fresh_folder(rows.sparkSession))


def land_whole(rows: DataFrame, key: str, path: str) -> str:
    """Rows as answers of one page each."""
    pages = landed_pages(rows, key)
    return written(pages.select("data", F.lit(False).alias("has_more")), path)


def read_back(t: Tables) -> DataFrame:
    rows = t["textos_documentos"].withColumnRenamed("docto_ve_id", "DOCTO_VE_ID")
    return read_pages(rows.sparkSession, land(rows, "DOCTO_VE_ID"), ddl(DOC_SCHEMA), False, "textos_documentos")


def _missing_pages(t: Tables) -> DataFrame:
    """What is found wrong with answers of which every seventh page was lost."""
    rows = t["textos_documentos"]
    pages = landed_pages(rows, "docto_ve_id").filter(f"cursor / {PAGE} % 7 <> 3")
    headers = strict(rows.sparkSession).schema(HEADER).json(written(pages, fresh_folder(rows.sparkSession)))
    return chain_faults(headers)


both(
    "T1_paginas_perdidas",
    _missing_pages,
    f"""{ctes('textos_documentos')}, k AS (SELECT DISTINCT CAST(trim(docto_ve_id) AS BIGINT) // {PAGE} * {PAGE} AS first FROM textos_documentos),
p AS (SELECT first // {ANSWER} AS a, row_number() OVER w AS place, lead(first) OVER w AS next_cursor, first FROM k WINDOW w AS (PARTITION BY first // {ANSWER} ORDER BY first)),
h AS (SELECT CAST(a AS VARCHAR) AS answer, CASE WHEN place = 1 THEN 0 ELSE first END AS "cursor", next_cursor IS NOT NULL AS has_more, next_cursor FROM p),
l AS (SELECT *, row_number() OVER w AS place, lead("cursor") OVER w AS after FROM h WHERE "cursor" // {PAGE} % 7 <> 3 WINDOW w AS (PARTITION BY answer ORDER BY "cursor")),
f AS (SELECT answer, "cursor", has_more, next_cursor, CASE WHEN place = 1 AND "cursor" <> 0 THEN 'the first page is missing before the page asked with cursor ' || "cursor"
  WHEN has_more AND after IS NULL THEN 'the last page of a paged answer is missing: cursor ' || next_cursor
  WHEN has_more AND after <> next_cursor THEN 'the page asked with cursor ' || "cursor" || ' announces cursor ' || next_cursor || ', the next page was asked with ' || after END AS fault FROM l)
SELECT * FROM f WHERE fault IS NOT NULL""",
)
both(
    "S1_paginas",
    lambda t: read_back(t).drop("CLIENTE_ID"),
    f"{ctes('textos_documentos')} SELECT docto_ve_id AS DOCTO_VE_ID, FOLIO, IMPORTE_NETO, FECHA, FECHA_HORA_CREACION FROM textos_documentos",
)
both("S2_tipos", lambda t: type_rows(t["textos_documentos"], ddl(DOC_SCHEMA)), f"{TYPED_DOCS} FROM orders")
both(
    "S3_metadatos",
    lambda t: finalise(
        t["textos_documentos"], ddl("DOCTO_VE_ID BIGINT NOT NULL, FECHA DATE NOT NULL, EMPRESA STRING NOT NULL, _synced_at TIMESTAMP NOT NULL"), COMPANY, datetime(2001, 8, 1, 3, 0, 0)
    ).withColumn("_synced_at", F.date_format(F.to_utc_timestamp("_synced_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss")),
    "SELECT o_orderkey AS DOCTO_VE_ID, CAST(o_orderdate AS DATE) AS FECHA, 'E1' AS EMPRESA, '2001-08-01 03:00:00' AS _synced_at FROM orders",
)
_RULE_TEXT = """reglas AS (SELECT TRY_CAST(trim(ORDEN) AS BIGINT) AS ORDEN, trim(patron) AS PATRON, trim(FORMATO) AS FORMATO,
  CASE WHEN lower(trim(coalesce(Incluir, ''))) IN ('true', '1', 'sí') THEN TRUE WHEN lower(trim(coalesce(Incluir, ''))) IN ('no', '') THEN FALSE END AS INCLUIR
  FROM textos_reglas WHERE trim(patron) <> '')"""
_RULE_REASON = """CASE WHEN ORDEN IS NULL THEN 'ORDEN is not an integer' WHEN PATRON = '(abc' THEN 'PATRON is not a valid pattern'
  WHEN FORMATO = '' THEN 'FORMATO is empty' WHEN INCLUIR IS NULL THEN 'INCLUIR is not a boolean' END"""
both(
    "S4_reglas",
    lambda t: good_rules(t["textos_reglas"]),
    f"{ctes('textos_reglas')}, {_RULE_TEXT} SELECT * FROM reglas WHERE ({_RULE_REASON}) IS NULL",
)
both(
    "S4_reglas_rechazadas",
    lambda t: check_rules(t["textos_reglas"]).filter("reason IS NOT NULL"),
    f"{ctes('textos_reglas')}, {_RULE_TEXT} SELECT *, {_RULE_REASON} AS reason FROM reglas WHERE ({_RULE_REASON}) IS NOT NULL",
)


FEED_SCHEMA = "EMPRESA STRING NOT NULL, DOCTO_VE_ID BIGINT NOT NULL, TIPO_DOCTO STRING, FECHA DATE NOT NULL, CLIENTE_ID BIGINT, IMPORTE_NETO DECIMAL(38,9)"


def _landed_feeds(t: Tables) -> DataFrame:
    """Each type's documents landed without the type, which the feed says; the last feed brings its own, or none."""
    docs, feeds = t[DOCS], {}
    for tipo in ("F", "R", "P", "C", "D"):
        rows = docs.filter(F.col("TIPO_DOCTO") == tipo)
        if tipo != "D":
            rows = rows.drop("TIPO_DOCTO")
        path = land(rows.filter(F.lit(tipo != "D") | (F.col("DOCTO_VE_ID") % 3 != 0)), "DOCTO_VE_ID")
        feeds[tipo] = read_pages_with_defaults(docs.sparkSession, path, ddl(FEED_SCHEMA), {"TIPO_DOCTO": tipo}, DOCS)
    return type_rows(tagged_union(feeds), ddl(FEED_SCHEMA))


both(
    "S5_union_etiquetada",
    _landed_feeds,
    f"SELECT * FROM ({ctes(DOCS)} SELECT {DOC_COLS}, {dbl('IMPORTE_NETO')} FROM {DOCS} WHERE NOT (TIPO_DOCTO = 'D' AND DOCTO_VE_ID % 3 = 0)) x",
)
_DELTA = f"ARTICULO_ID, ALMACEN_ID, {dbl(BALANCE_AMOUNTS)}"


#: The months that hold balances.
_BALANCE_MONTHS = (date(1992, 1, 1), date(2001, 12, 1))


def _month_rows(t: Tables, first: date) -> DataFrame:
    rows = t["fact_saldos_mensuales"].filter((F.col("PERIODO") == F.lit(first)) & ~F.col("ES_SALDO_INICIAL"))
    return rows.drop("PERIODO", "ES_SALDO_INICIAL", "EMPRESA")


both(
    "S6_deltas_mensuales",
    lambda t: union_all([month_delta(_month_rows(t, m), m) for m in jobs.months(*_BALANCE_MONTHS)]),
    f"""{ctes('fact_saldos_mensuales')} SELECT {_DELTA}, PERIODO, FALSE AS ES_SALDO_INICIAL FROM fact_saldos_mensuales
WHERE NOT ES_SALDO_INICIAL""",
)
both(
    "S7_saldo_inicial",
    lambda t: opening_balance(t["inventario_existencias"].filter(F.col("_snapshot_date") == F.lit(AS_OF)), date(2001, 2, 17)),
    f"""{ctes('inventario_existencias')} SELECT DATE '2001-02-01' AS PERIODO, 2001::BIGINT AS ANO, 2::BIGINT AS MES, 28::BIGINT AS ULTIMO_DIA, ARTICULO_ID, ALMACEN_ID,
  CAST(EXISTENCIA AS DOUBLE) AS ENTRADAS_UNIDADES, 0 AS SALIDAS_UNIDADES, CAST(COSTO AS DOUBLE) AS ENTRADAS_COSTO, 0 AS SALIDAS_COSTO, TRUE AS ES_SALDO_INICIAL
FROM inventario_existencias WHERE _snapshot_date = DATE '2001-08-01'""",
)
both(
    "S8_fotografia",
    lambda t: snapshot_of(t["inventario_existencias"].filter(F.col("_snapshot_date") == F.lit(AS_OF)).drop("_snapshot_date"), date(2026, 9, 10)),
    f"""{ctes('inventario_existencias')} SELECT EMPRESA, ARTICULO_ID, ALMACEN_ID, {dbl('EXISTENCIA COSTO')}, DATE '2026-09-10' AS _snapshot_date
FROM inventario_existencias WHERE _snapshot_date = DATE '2001-08-01'""",
)


def _inferred(t: Tables) -> DataFrame:
    """The events' properties landed as a catalog whose columns nobody declared."""
    rows = t["events"]
    path = fresh_folder(rows.sparkSession)
    rows.select(F.concat(F.lit('{"data": ['), F.coalesce("props", F.lit("{}")), F.lit("]}")).alias("value")).write.text(path)
    return read_inferred_pages(rows.sparkSession, path)


both("S9_columnas_inferidas", _inferred, "SELECT CAST(props->>'$.k' AS BIGINT) AS k FROM events")


def _inferred_twice(t: Tables) -> DataFrame:
    """The catalog of two nights: whole numbers, then numbers with a fraction, a column of nulls, and a number for a text."""
    rows, spec = t["events"], TableSpec("catalogo", None)
    spark, key = rows.sparkSession, F.col("event_id")
    store = Store(spark, fresh_folder(spark))
    nights = (
        rows.select(key.alias("ID"), F.col("user_id").alias("N"), F.col("event_type").alias("X"), (key % 2 == 0).alias("B"), key.alias("S")),
        rows.select(key.alias("ID"), (F.col("user_id") / 4).alias("n"), key.alias("X"), F.lit(None).cast("boolean").alias("B"), F.concat(F.lit("s"), key).alias("S")),
    )
    for night in nights:
        path = fresh_folder(spark)
        pages = night.groupBy(F.floor(F.col("ID") / PAGE)).agg(F.collect_list(F.struct(*night.columns)).alias("data")).select("data")
        pages.select(F.to_json(F.struct("data"), {"ignoreNullFields": "false"}).alias("value")).write.text(path)
        store.full_refresh(spec, read_inferred_pages(spark, path, True, spec.name, store.columns(spec)))
    kinds = {f.name.upper(): f.dataType.simpleString() for f in store.columns(spec)}
    return store.read(spec).withColumn("tipos", F.lit(" ".join(f"{c} {kinds[c]}" for c in sorted(kinds))))


both(
    "S9_tipos_conciliados",
    _inferred_twice,
    """SELECT event_id AS ID, CAST(user_id / 4.0 AS DOUBLE) AS n, CAST(event_id AS VARCHAR) AS X, CAST(NULL AS BOOLEAN) AS B, 's' || event_id AS S,
  'B boolean ID bigint N decimal(38,9) S string X string' AS tipos FROM events""",
)
both(
    "S10_ultima_fecha_buena",
    lambda t: last_good_date(t["_etl_sync_state"], "click"),
    f"""{ctes('_etl_sync_state')} SELECT max(last_sync_date) AS last_sync_date FROM (SELECT * FROM _etl_sync_state
  WHERE table_name = 'click' AND status = 'success' ORDER BY last_run_at DESC, last_sync_date DESC LIMIT 1) x""",
)
both(
    "S10_ultimas_fechas_buenas",
    lambda t: last_good_dates(t["_etl_sync_state"]),
    f"""{ctes('_etl_sync_state')} SELECT table_name, last_run_at, last_sync_date FROM _etl_sync_state WHERE status = 'success'
QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY last_run_at DESC, last_sync_date DESC) = 1""",
)

# --- L: loads into a store, read back ---


def stored(rows: DataFrame, name: str, load: str, **layout) -> tuple[Store, TableSpec]:
    """A fresh store, and a table of the rows' columns."""
    spec = TableSpec(name, rows._jdf.schema().toDDL(), load, **layout)
    return Store(rows.sparkSession, fresh_folder(rows.sparkSession)), spec


_DOC_ROW = f"{DOC_COLS}, {dbl('IMPORTE_NETO')}"


def _docs(t: Tables, test: str) -> DataFrame:
    return t[DOCS].filter(test)


def _loaded(t: Tables, first: str, then: str, load: str = model.FULL_REFRESH) -> DataFrame:
    """Documents that pass one test, then those that pass another, by one kind of load."""
    store, spec = stored(t[DOCS], DOCS, load)
    step = store.append if load == model.APPEND else store.full_refresh
    step(spec, _docs(t, first))
    step(spec, _docs(t, then))
    return store.read(spec)


both(
    "L1_recarga",
    lambda t: _loaded(t, "TIPO_DOCTO <> 'F'", "TIPO_DOCTO = 'F'"),
    f"{ctes(DOCS)} SELECT {_DOC_ROW} FROM {DOCS} WHERE TIPO_DOCTO = 'F'",
)
both(
    "L1_recarga_vacia",
    lambda t: _loaded(t, "TIPO_DOCTO <> 'F'", "TIPO_DOCTO = 'Z'"),
    f"{ctes(DOCS)} SELECT {_DOC_ROW} FROM {DOCS} WHERE TIPO_DOCTO <> 'F'",
)
both(
    "L2_agregar",
    lambda t: _loaded(t, "TIPO_DOCTO <> 'F'", "CLIENTE_ID % 2 = 0", model.APPEND),
    f"{ctes(DOCS)} SELECT {_DOC_ROW} FROM {DOCS} WHERE TIPO_DOCTO <> 'F' UNION ALL SELECT {_DOC_ROW} FROM {DOCS} WHERE CLIENTE_ID % 2 = 0",
)
#: Every day of the given tables.
_DAYS = (date(1992, 1, 1), date(2002, 12, 31))
_STOCK_ROW = "EMPRESA, _snapshot_date, ARTICULO_ID, ALMACEN_ID"


def _day_replaced(t: Tables) -> DataFrame:
    rows = t[STOCK.name]
    store, spec = stored(rows, STOCK.name, model.SNAPSHOT, partition_by="_snapshot_date", cluster_by=("ALMACEN_ID",))
    store.replace_range(spec, rows, *_DAYS)
    store.replace_day(spec, rows.filter(F.col("ARTICULO_ID") % 2 == 0).withColumn("COSTO", (F.col("COSTO") * 2).cast(rows.schema["COSTO"].dataType)), AS_OF)
    store.replace_day(spec, rows, date(2002, 12, 30))  # a day without rows stays as it was
    return store.read(spec)


both(
    "L3_reemplazar_dia",
    _day_replaced,
    f"""{ctes('inventario_existencias')} SELECT {_STOCK_ROW}, {dbl('EXISTENCIA COSTO')} FROM inventario_existencias WHERE _snapshot_date <> DATE '2001-08-01'
UNION ALL SELECT {_STOCK_ROW}, {dbl('EXISTENCIA')}, CAST(COSTO * 2 AS DOUBLE) FROM inventario_existencias WHERE _snapshot_date = DATE '2001-08-01' AND ARTICULO_ID % 2 = 0""",
)
#: Months are the partitions of the tables below; days are those of the jobs.
_QUARTER = (date(2000, 4, 1), date(2000, 6, 1))
_IN_QUARTER = "FECHA BETWEEN DATE '2000-04-01' AND DATE '2000-06-30'"


def _monthly(t: Tables, table: str) -> DataFrame:
    return t[table].withColumn("PERIODO", month(F.col("FECHA")))


def _changed_sales(rows: DataFrame, test: str) -> DataFrame:
    return rows.filter(test).withColumn("UNIDADES", (F.col("UNIDADES") + 1).cast(rows.schema["UNIDADES"].dataType))


def _stored_sales(t: Tables, **layout) -> tuple[Store, TableSpec, DataFrame]:
    rows = _monthly(t, SALES.name)
    store, spec = stored(rows, SALES.name, model.REPLACE_RANGE, partition_by="PERIODO", cluster_by=SALES.cluster_by, **layout)
    store.replace_range(spec, rows, *_DAYS)
    return store, spec, rows


def _range_replaced(t: Tables) -> DataFrame:
    """A quarter without its second month, and a load of all sales that may only touch a month that has none."""
    store, spec, _ = _stored_sales(t)
    rows = store.read(spec)  # all of them, as the first load has written them: the facts are joined once
    store.replace_range(spec, _changed_sales(rows, f"{_IN_QUARTER} AND month(FECHA) <> 5"), *_QUARTER)
    store.replace_range(spec, rows, date(2002, 12, 1), date(2002, 12, 31))
    return store.read(spec).drop("PERIODO")


def _range_emptied(t: Tables) -> DataFrame:
    store, spec, rows = _stored_sales(t)
    store.replace_range(spec, rows.filter("false"), *_QUARTER)
    return store.read(spec).drop("PERIODO")


both(
    "L4_reemplazar_rango",
    _range_replaced,
    f"""{ctes(SALES.name)} SELECT {SALE_COLS}, {dbl(SALE_AMOUNTS)} FROM {SALES.name} WHERE NOT ({_IN_QUARTER})
UNION ALL SELECT {SALE_COLS}, CAST(UNIDADES + 1 AS DOUBLE), {dbl(SALE_AMOUNTS.replace('UNIDADES ', ''))} FROM {SALES.name}
WHERE {_IN_QUARTER} AND month(FECHA) <> 5""",
)
both(
    "L4_reemplazar_rango_vacio",
    _range_emptied,
    f"{ctes(SALES.name)} SELECT {SALE_COLS}, {dbl(SALE_AMOUNTS)} FROM {SALES.name} WHERE NOT ({_IN_QUARTER})",
)
_TWO_MONTHS = [date(2000, 4, 1), date(2000, 5, 1)]
_IN_MONTHS = "PERIODO IN (DATE '2000-04-01', DATE '2000-05-01')"


def _months_replaced(t: Tables) -> DataFrame:
    rows = t[BALANCES.name]
    store, spec = stored(rows, BALANCES.name, model.REPLACE_MONTHS, partition_by="PERIODO", cluster_by=BALANCES.cluster_by)
    store.replace_range(spec, rows, *_DAYS)
    store.replace_months(spec, rows.filter("ARTICULO_ID % 3 = 0"), _TWO_MONTHS)
    return store.read(spec)


both(
    "L5_reemplazar_meses",
    _months_replaced,
    f"""{ctes('fact_saldos_mensuales')} SELECT EMPRESA, PERIODO, ARTICULO_ID, ALMACEN_ID, {dbl(BALANCE_AMOUNTS)}, ES_SALDO_INICIAL
FROM fact_saldos_mensuales WHERE NOT {_IN_MONTHS} OR ARTICULO_ID % 3 = 0""",
)


def _upserted(t: Tables) -> DataFrame:
    """Changed and new documents, some of them moved to another month."""
    rows = _monthly(t, DOCS)
    store, spec = stored(rows, DOCS, model.UPSERT, key="DOCTO_VE_ID", partition_by="PERIODO")
    store.upsert(spec, rows.filter("DOCTO_VE_ID % 10 <> 0"))
    moved = F.when(F.col("DOCTO_VE_ID") % 25 == 0, F.date_add("FECHA", 40)).otherwise(F.col("FECHA"))
    more = (F.col("IMPORTE_NETO") + 1).cast(spec.schema["IMPORTE_NETO"].dataType)
    changed = rows.filter("DOCTO_VE_ID % 5 = 0").withColumns({"IMPORTE_NETO": more, "CLIENTE_ID": F.lit(None).cast("bigint"), "FECHA": moved})
    store.upsert(spec, changed.withColumn("PERIODO", month(F.col("FECHA"))))
    return store.read(spec).drop("PERIODO")


both(
    "L6_upsert",
    _upserted,
    f"""{ctes(DOCS)} SELECT EMPRESA, DOCTO_VE_ID, TIPO_DOCTO, CASE WHEN DOCTO_VE_ID % 25 = 0 THEN FECHA + 40 ELSE FECHA END AS FECHA,
  CASE WHEN DOCTO_VE_ID % 5 <> 0 THEN CLIENTE_ID END AS CLIENTE_ID,
  CAST(CASE WHEN DOCTO_VE_ID % 5 = 0 THEN IMPORTE_NETO + 1 ELSE IMPORTE_NETO END AS DOUBLE) AS IMPORTE_NETO FROM {DOCS}""",
)
_YEAR_1998 = date(1998, 1, 1)


def _widened(t: Tables) -> DataFrame:
    """Sales loaded before and after the table got two columns, which earlier months read as NULL."""
    rows = _monthly(t, SALES.name)
    store, wide = stored(rows, SALES.name, model.REPLACE_RANGE, partition_by="PERIODO")
    old = rows.drop("IMPUESTOS", "IMPORTE_TOTAL")
    narrow = TableSpec(SALES.name, old._jdf.schema().toDDL(), model.REPLACE_RANGE, partition_by="PERIODO")
    store.create(narrow)
    store.replace_range(narrow, old, _DAYS[0], _YEAR_1998 - timedelta(days=1))
    store.create(wide)
    store.replace_range(wide, rows, _YEAR_1998, _DAYS[1])
    return store.read(wide).drop("PERIODO")


both(
    "L7_columnas_nuevas",
    _widened,
    f"""{ctes(SALES.name)} SELECT {SALE_COLS}, {dbl('UNIDADES IMPORTE_NETO COSTO UTILIDAD')},
  CAST(CASE WHEN FECHA >= DATE '1998-01-01' THEN IMPUESTOS END AS DOUBLE) AS IMPUESTOS,
  CAST(CASE WHEN FECHA >= DATE '1998-01-01' THEN IMPORTE_TOTAL END AS DOUBLE) AS IMPORTE_TOTAL FROM {SALES.name}""",
)


def _created(t: Tables) -> DataFrame:
    """A created table has its columns and no rows: what a load finds missing is what it was given."""
    store, spec = stored(t[DOCS], DOCS, model.UPSERT, key="DOCTO_VE_ID", partition_by="FECHA")
    store.create(spec)
    return t[DOCS].unionByName(store.read(spec)).withColumn("columnas", F.lit(",".join(store.columns(spec).names)))


both(
    "L8_crear_tabla",
    _created,
    f"{ctes(DOCS)} SELECT {_DOC_ROW}, 'EMPRESA,DOCTO_VE_ID,TIPO_DOCTO,FECHA,CLIENTE_ID,IMPORTE_NETO' AS columnas FROM {DOCS}",
)


def _expired(t: Tables) -> DataFrame:
    store, spec, _ = _stored_sales(t, retention_days=SALES.retention_days)
    store.expire(spec, AS_OF)
    return store.read(spec).drop("PERIODO")


both(
    "L9_retencion",
    _expired,
    f"{ctes(SALES.name)} SELECT {SALE_COLS}, {dbl(SALE_AMOUNTS)} FROM {SALES.name} WHERE {MES} >= DATE '2001-08-01' - 1100",
)


def _log_loads(t: Tables) -> DataFrame:
    """One log row per month of sales, as a load of that month would append it."""
    store, spec = stored(t[SYNC_LOG.name], SYNC_LOG.name, model.APPEND)
    loaded = t[SALES.name].groupBy(F.last_day("FECHA").alias("last_sync_date")).agg(F.count(F.lit(1)).alias("records_synced"))
    rows = loaded.withColumns(
        {"table_name": F.lit(SALES.name), "last_run_at": F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), "status": F.lit("success")}
    )
    store.append(spec, t[SYNC_LOG.name])
    store.append(spec, rows.select(*spec.schema.names))
    return store.read(spec)


both(
    "L10_bitacora",
    _log_loads,
    f"""{ctes(f'{SALES.name} {SYNC_LOG.name}')} SELECT table_name, last_sync_date, last_run_at, records_synced, status FROM {SYNC_LOG.name}
UNION ALL SELECT 'fact_ventas_articulo', last_day(FECHA), TIMESTAMP '2024-01-31 00:00:00', count(*), 'success' FROM {SALES.name} GROUP BY 2""",
)

# --- what is kept of tables, by month and year ---

_JULY = (date(2001, 7, 1), date(2001, 7, 31))


def _kept(t: Tables, store: Store, spec: TableSpec, name: str, *loads) -> Tables:
    """The stored table and what is kept of it: all but the last load are summed up, the last is read from the table."""
    rollup = replace(ROLLUPS[name], source=spec)
    for load in loads:
        rollup.refresh(store)
        load()
    return t.replacing(**{spec.name: store.read(spec), name: rollup.read(store)})


def _kept_sales(t: Tables) -> DataFrame:
    """Recent units and last sales after a quarter was replaced and a month emptied."""
    store, spec, rows = _stored_sales(t)
    kept = _kept(
        t, store, spec, LAST_SALES.name,
        lambda: store.replace_range(spec, _changed_sales(rows, f"{_IN_QUARTER} AND month(FECHA) <> 5"), *_QUARTER),
        lambda: store.replace_range(spec, rows.filter("false"), *_JULY),
    )
    return inventory.sales_so_far(kept, AS_OF).filter("VENDIDAS IS NOT NULL OR ULTIMA_VENTA IS NOT NULL")


both(
    "V06_ventas_guardadas",
    _kept_sales,
    f"""{ctes(SALES.name)}, g AS (SELECT EMPRESA, ARTICULO_ID, ALMACEN_ID, sum(UNIDADES) FILTER (FECHA >= DATE '2001-08-01' - 90) AS n,
  max(FECHA) FILTER (TIPO_DOCTO = 'F') AS ULTIMA_VENTA FROM {SALES.name}
  WHERE NOT ({_IN_QUARTER} AND month(FECHA) = 5) AND FECHA NOT BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY ALL)
SELECT EMPRESA, ARTICULO_ID, ALMACEN_ID, CAST(n AS DOUBLE) AS VENDIDAS, ULTIMA_VENTA FROM g WHERE n IS NOT NULL OR ULTIMA_VENTA IS NOT NULL""",
)


def _kept_purchases(t: Tables) -> DataFrame:
    rows = _monthly(t, PURCHASES.name)
    store, spec = stored(rows, PURCHASES.name, model.REPLACE_RANGE, partition_by="PERIODO")
    store.replace_range(spec, rows, *_DAYS)
    kept = _kept(
        t, store, spec, LAST_PURCHASES.name,
        lambda: store.replace_range(spec, rows.filter("ARTICULO_ID % 2 = 0"), *_QUARTER),
        lambda: store.replace_range(spec, rows.filter("ARTICULO_ID % 3 = 0"), *_JULY),
    )
    return inventory.last_receipts(kept)


both(
    "V06_compras_guardadas",
    _kept_purchases,
    f"""{ctes(PURCHASES.name)} SELECT EMPRESA, ARTICULO_ID, max(FECHA) AS ULTIMA_COMPRA FROM {PURCHASES.name}
WHERE TIPO_DOCTO = 'C' AND ESTATUS <> 'C' AND (NOT ({_IN_QUARTER}) OR ARTICULO_ID % 2 = 0)
  AND (FECHA NOT BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' OR ARTICULO_ID % 3 = 0) GROUP BY ALL""",
)


def _kept_balances(t: Tables) -> DataFrame:
    """Stock of one month, from the sums of the years before and the month's own year."""
    rows = t[BALANCES.name]
    store, spec = stored(rows, BALANCES.name, model.REPLACE_MONTHS, partition_by="PERIODO", cluster_by=BALANCES.cluster_by)
    store.replace_range(spec, rows, *_DAYS)
    kept = _kept(
        t, store, spec, YEAR_BALANCES.name,
        lambda: store.replace_months(spec, rows.filter("ARTICULO_ID % 3 = 0"), _TWO_MONTHS),
        lambda: store.replace_months(spec, rows.filter("ARTICULO_ID % 5 = 0"), [date(1999, 1, 1)]),
    )
    return inventory.closing_stock(kept, AS_OF, date(2001, 3, 1))


both(
    "V14_saldos_guardados",
    _kept_balances,
    f"""{ctes(BALANCES.name)}, g AS (SELECT EMPRESA, ARTICULO_ID, ALMACEN_ID, sum(coalesce(ENTRADAS_UNIDADES, 0) - coalesce(SALIDAS_UNIDADES, 0)) AS EXISTENCIA_FIN_MES,
  sum(coalesce(ENTRADAS_COSTO, 0) - coalesce(SALIDAS_COSTO, 0)) AS VALOR_COSTO_FIN_MES FROM {BALANCES.name} WHERE PERIODO <= DATE '2001-03-01'
  AND (NOT {_IN_MONTHS} OR ARTICULO_ID % 3 = 0) AND (PERIODO <> DATE '1999-01-01' OR ARTICULO_ID % 5 = 0) GROUP BY ALL)
SELECT EMPRESA, ARTICULO_ID, ALMACEN_ID, DATE '2001-03-01' AS PERIODO, {dbl('EXISTENCIA_FIN_MES VALOR_COSTO_FIN_MES')} FROM g""",
)

# --- P: the supplier extracts as files ---

_STAY = "PROVEEDOR_ID % 9 <> 0"


def _published(t: Tables, name: str) -> DataFrame:
    """An extract published for all suppliers, and again when every third of them has left."""
    spark = t[PURCHASES.name].sparkSession
    publication = Publication(Store(spark, fresh_folder(spark)))
    publication.publish(t, AS_OF, [name])
    stay = {n: t[n].filter(_STAY) for n in (PURCHASES.name, "dim_articulo_proveedor")}
    publication.publish(t.replacing(**stay), AS_OF, [name])
    return publication.read(name)


both("P1_publicado", lambda t: _published(t, "sellout"), f"{_SELL_OUT} SELECT PROVEEDOR_ID, {_SALES_COLS} FROM r WHERE {_STAY}")
both("P2_publicado", lambda t: _published(t, "sellin"), f"{_SELL_IN} SELECT PROVEEDOR_ID, {_SALES_COLS}, COMPRAS FROM r WHERE {_STAY}")
both("P3_publicado", lambda t: _published(t, "inventario_actual"), f"{_NOW_BY} SELECT * FROM r WHERE {_STAY}")


def _published_months(t: Tables) -> DataFrame:
    """The month series of all suppliers, published whole; what was written is added up by supplier and month."""
    spark = t[PURCHASES.name].sparkSession
    publication = Publication(Store(spark, fresh_folder(spark)))
    publication.publish(t, AS_OF, ["inventario_mensual"])
    sums = [F.sum(c).alias(c) for c in ("EXISTENCIA_FIN_MES", "UNIDADES_VENDIDAS")]
    return publication.read("inventario_mensual").groupBy("PROVEEDOR_ID", "PERIODO").agg(F.count(F.lit(1)).alias("renglones"), *sums)


both(
    "P4_publicado",
    _published_months,
    f"""{_MONTHS_BY} SELECT PROVEEDOR_ID, PERIODO, count(*) AS renglones, sum(EXISTENCIA_FIN_MES) AS EXISTENCIA_FIN_MES,
  sum(UNIDADES_VENDIDAS) AS UNIDADES_VENDIDAS FROM r GROUP BY ALL""",
)

# --- J: refresh jobs over a landing folder ---

_FIRST, _CHUNK = date(1995, 1, 1), 7


def _rows_per_chunk(t: Tables) -> DataFrame:
    """Sales rows each backfill chunk would replace: chunks become days, days meet the daily counts."""
    spark = t[SALES.name].sparkSession
    chunks = spark.createDataFrame(list(jobs.date_chunks(_FIRST, AS_OF, _CHUNK)), "desde date, hasta date")
    days = chunks.withColumn("FECHA", F.explode(F.sequence("desde", "hasta")))
    daily = t[SALES.name].groupBy("FECHA").agg(F.count(F.lit(1)).alias("n"))
    return days.join(daily, "FECHA", "left").groupBy("desde", "hasta").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("renglones"))


both(
    "J1_tramos",
    _rows_per_chunk,
    f"""{ctes(SALES.name)}, c AS (SELECT CAST(d AS DATE) AS desde, least(CAST(d AS DATE) + 6, DATE '2001-08-01') AS hasta
  FROM unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 7 DAY)) AS s(d))
SELECT desde, hasta, count(FECHA) AS renglones FROM c LEFT JOIN {SALES.name} ON FECHA BETWEEN desde AND hasta GROUP BY 1, 2""",
)


def _rows_per_month(t: Tables) -> DataFrame:
    spark = t[SALES.name].sparkSession
    wanted = spark.createDataFrame([(m,) for m in jobs.months(date(1994, 11, 20), AS_OF)], "MES date")
    monthly = t[SALES.name].groupBy(month(F.col("FECHA")).alias("MES")).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(monthly, "MES", "left").select("MES", F.coalesce("n", F.lit(0)).alias("renglones"))


both(
    "J2_meses",
    _rows_per_month,
    f"""{ctes(SALES.name)}, m AS (SELECT CAST(d AS DATE) AS MES FROM unnest(generate_series(DATE '1994-11-01', DATE '2001-08-01', INTERVAL 1 MONTH)) AS s(d))
SELECT m.MES, count(FECHA) AS renglones FROM m LEFT JOIN {SALES.name} ON {MES} = m.MES GROUP BY 1""",
)
_WINDOW = "FECHA BETWEEN DATE '2001-06-17' AND DATE '2001-08-01'"
_HISTORY = "FECHA BETWEEN DATE '1998-08-01' AND DATE '2001-08-01'"


def _refresh(store: Store, landing: str, **options) -> jobs.Refresh:
    """Jobs of the last order date; one pass loads the three years of history that a backfill brings unless told otherwise."""
    now = datetime(2001, 8, 2, tzinfo=timezone.utc)
    return jobs.Refresh(store, landing, COMPANY, AS_OF, "", chunks_per_pass=1000, now=lambda: now, **options)


def _new_refresh(t: Tables) -> jobs.Refresh:
    spark = t[DOCS].sparkSession
    return _refresh(Store(spark, fresh_folder(spark)), fresh_folder(spark))


def _sales_window(t: Tables) -> DataFrame:
    """All history by a backfill, then a night whose source has changed the last 45 days, and days before that no load may touch."""
    job = _new_refresh(t)
    land_whole(t[SALES.name], "DOCTO_VE_ID", f"{job.landing}/{SALES.name}")
    job.backfill(_DAYS[0], tables=[SALES.name])
    night = _refresh(job.store, fresh_folder(job.spark), retention=False)
    # The source's pages as they were landed, changed row by row: the facts are joined and paged once.
    row = t[SALES.name].schema
    pages = strict(job.spark).schema(T.StructType([T.StructField("data", T.ArrayType(row))])).json(f"{job.landing}/{SALES.name}")
    kept = F.filter("data", lambda r: r["ARTICULO_ID"] % 4 != 0)
    changed = F.transform(kept, lambda r: r.withField("UNIDADES", (r["UNIDADES"] + 1).cast(row["UNIDADES"].dataType)))
    written(pages.select(changed.alias("data"), F.lit(False).alias("has_more")), f"{night.landing}/{SALES.name}")
    night.nightly([SALES.name])
    return job.store.read(SALES).select(*t[SALES.name].columns)


both(
    "J3_ventana_ventas",
    _sales_window,
    f"""{ctes(SALES.name)} SELECT {SALE_COLS}, CAST(UNIDADES + CASE WHEN {_WINDOW} THEN 1 ELSE 0 END AS DOUBLE) AS UNIDADES,
  {dbl(SALE_AMOUNTS.replace('UNIDADES ', ''))} FROM {SALES.name} WHERE NOT ({_WINDOW} AND ARTICULO_ID % 4 = 0)""",
)


def _land_feeds(rows: DataFrame, landing: str, without: str = "") -> None:
    for feed, tipo in SALES_FEEDS.items():
        if tipo != without:
            land(rows.filter(F.col("TIPO_DOCTO") == tipo), "DOCTO_VE_ID", f"{landing}/{DOCS}/{feed}")


def _documents_window(t: Tables) -> DataFrame:
    """Headers in paged answers, feed by feed; the night's upsert keeps what its window does not bring."""
    job = _new_refresh(t)
    _land_feeds(t[DOCS], job.landing)
    job.backfill(_DAYS[0], AS_OF - timedelta(days=1), [DOCS])
    night = _refresh(job.store, fresh_folder(job.spark), retention=False)
    _land_feeds(t[DOCS].withColumn("IMPORTE_NETO", -F.col("IMPORTE_NETO")), night.landing)
    night.nightly([DOCS])
    return job.store.read(SALES_DOCS).select(*t[DOCS].columns)


both(
    "J3_ventana_documentos",
    _documents_window,
    f"{ctes(DOCS)} SELECT {DOC_COLS}, CAST(CASE WHEN {_WINDOW} THEN -IMPORTE_NETO ELSE IMPORTE_NETO END AS DOUBLE) AS IMPORTE_NETO FROM {DOCS}",
)


def _recent_balances(t: Tables) -> DataFrame:
    """A store with all months, of which a night loads the last two again."""
    job, rows = _new_refresh(t), t[BALANCES.name]
    whole = rows.withColumns({"ANO": F.year("PERIODO"), "MES": F.month("PERIODO")})
    job.store.replace_range(BALANCES, finalise(whole, BALANCES.schema, COMPANY, job.now(), BALANCES.name), *_DAYS)
    for m in (jobs.add_months(AS_OF, -1), jobs.add_months(AS_OF, 0)):
        months = whole.filter((F.col("PERIODO") == F.lit(m)) & ~F.col("ES_SALDO_INICIAL") & (F.col("ARTICULO_ID") % 2 == 1))
        land_whole(months.drop("PERIODO", "ES_SALDO_INICIAL", "EMPRESA"), "ARTICULO_ID", f"{job.landing}/{BALANCES.name}/{m:%Y-%m}")
    job.nightly([BALANCES.name])
    return job.store.read(BALANCES).select(*rows.columns)


both(
    "J4_saldos_recientes",
    _recent_balances,
    f"""{ctes('fact_saldos_mensuales')} SELECT EMPRESA, PERIODO, ARTICULO_ID, ALMACEN_ID, {dbl(BALANCE_AMOUNTS)}, ES_SALDO_INICIAL FROM fact_saldos_mensuales
WHERE PERIODO NOT IN (DATE '2001-07-01', DATE '2001-08-01') OR ARTICULO_ID % 2 = 1""",
)


def _resumed(t: Tables) -> DataFrame:
    """The log of a backfill that stopped and of the one that went on: each chunk once, with its own rows."""
    job = _new_refresh(t)
    land(t[PURCHASES.name], "DOCTO_CM_DET_ID", f"{job.landing}/{PURCHASES.name}")
    job.backfill(tables=[PURCHASES.name], end=date(2000, 3, 31))
    job.backfill(tables=[PURCHASES.name])
    log = job.store.read(SYNC_LOG).select("table_name", "last_sync_date", "records_synced", "status")
    rows = job.store.read(PURCHASES).agg(F.count(F.lit(1)))
    return log.withColumn("renglones", rows.scalar())


both(
    "J5_reanudar",
    _resumed,
    f"""{ctes(PURCHASES.name)}, c AS (
  SELECT CAST(d AS DATE) AS desde, least(CAST(d AS DATE) + 30, DATE '2000-03-31') AS hasta FROM unnest(generate_series(DATE '1998-08-01', DATE '2000-03-31', INTERVAL 31 DAY)) AS s(d)
  UNION ALL SELECT CAST(d AS DATE), least(CAST(d AS DATE) + 30, DATE '2001-08-01') FROM unnest(generate_series(DATE '2000-04-01', DATE '2001-08-01', INTERVAL 31 DAY)) AS s(d))
SELECT 'fact_compras_partidas:backfill' AS table_name, hasta AS last_sync_date, count(FECHA) AS records_synced, 'success' AS status,
  (SELECT count(*) FROM {PURCHASES.name} WHERE {_HISTORY}) AS renglones
FROM c LEFT JOIN {PURCHASES.name} ON FECHA BETWEEN desde AND hasta GROUP BY hasta""",
)


def _night_with_failures(t: Tables) -> DataFrame:
    """The log of a night in which sales were cut off and headers lack a page; stock and suppliers load all the same."""
    job, stock = _new_refresh(t), t[STOCK.name].filter(F.col("_snapshot_date") == F.lit(AS_OF))
    sales = landed_pages(t[SALES.name], "DOCTO_VE_ID")
    written(sales.select("data", (F.col("cursor") == 0).alias("has_more")), f"{job.landing}/{SALES.name}")
    _land_feeds(t[DOCS], job.landing, without="F")
    written(landed_pages(t[DOCS].filter("TIPO_DOCTO = 'F'"), "DOCTO_VE_ID").filter("has_more"), f"{job.landing}/{DOCS}/facturas")
    land_whole(stock.drop("_snapshot_date"), "ARTICULO_ID", f"{job.landing}/saldos_iniciales/{AS_OF:%Y-%m}")
    land(t["dim_proveedores"], "PROVEEDOR_ID", f"{job.landing}/dim_proveedores")
    try:
        job.nightly([SALES.name, DOCS, STOCK.name, "dim_proveedores"])
    except jobs.RefreshError as error:
        return job.store.read(SYNC_LOG).select("table_name", "last_sync_date", "records_synced", "status", F.lit(str(error)).alias("falla"))
    raise AssertionError("the night went well")


both(
    "J6_fallas",
    _night_with_failures,
    f"""{ctes(f'dim_proveedores {STOCK.name}')}, l AS (
  SELECT 'inventario_existencias' AS table_name, count(*) AS records_synced, 'success' AS status FROM {STOCK.name} WHERE _snapshot_date = DATE '2001-08-01'
  UNION ALL SELECT 'dim_proveedores', count(*), 'success' FROM dim_proveedores
  UNION ALL SELECT 'ventas_documentos', 0, 'error' UNION ALL SELECT 'fact_ventas_articulo', 0, 'error')
SELECT *, DATE '2001-08-01' AS last_sync_date, 'failed: ventas_documentos, fact_ventas_articulo' AS falla FROM l""",
)
both(
    "T2_obligatorias",
    lambda t: require(t[DOCS], ["DOCTO_VE_ID", "FECHA"], DOCS),
    f"{ctes(DOCS)} SELECT {_DOC_ROW} FROM {DOCS} WHERE DOCTO_VE_ID IS NOT NULL AND FECHA IS NOT NULL",
)
