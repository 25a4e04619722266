"""Golden cases for S1-S9 and T1-T3."""

import json
import re
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows
from tianguis.sources.feeds import SALES_FEEDS, month_delta, opening_balance, snapshot_of, tagged_union
from tianguis.sources.pages import InferredTypes, read_inferred_pages, read_pages, read_pages_with_defaults
from tianguis.sources.rules import RuleFileError, read_rules
from tianguis.sources.typing import finalise, require, type_rows

DDL = "ID BIGINT NOT NULL, NOMBRE STRING, IMPORTE DECIMAL(38,9), FECHA DATE, CREADO TIMESTAMP_NTZ"
ddl = T.StructType.fromDDL


def land(folder, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "pages.json").write_text("\n".join(json.dumps(p) for p in pages), encoding="utf-8")
    return str(folder)


def page(data, more=False, following=None, **header):
    return {"data": data, "has_more": more, "next_cursor": following, **header}


def answer(name, *cursors, size=2):
    """The pages of one answer, which was asked with these cursors: ids from each cursor on, and one row on the last page."""
    pages = []
    for at, following in zip(cursors, [*cursors[1:], None]):
        ids = range(at + 1, at + 1 + (size if following else 1))
        pages.append(page([{"ID": i, "NOMBRE": name} for i in ids], following is not None, following, answer=name, cursor=at))
    return pages


READERS = [
    lambda spark, path: read_pages(spark, path, ddl(DDL)),
    lambda spark, path: read_pages_with_defaults(spark, path, ddl(DDL), {"IMPORTE": "0"}),
    lambda spark, path: read_inferred_pages(spark, path, whole_chunk=False),
]


@pytest.mark.parametrize("read", READERS)
def test_answers_of_several_pages_in_any_order(spark, tmp_path, read):
    pages = [*answer("north", 0, 40, 41), *answer("south", 0, 7), page([{"ID": 900, "NOMBRE": "alone"}]), {"has_more": False}]
    land(tmp_path / "t" / "zona=1", *reversed(pages))
    land(tmp_path / "t" / "zona=2", *answer("north", 0, 300))  # in another folder, another answer
    found = rows(read(spark, str(tmp_path / "t")).select(F.col("ID").cast("int"), "NOMBRE"))
    assert found == sorted([(i, "north") for i in (1, 2, 41, 42, 42, 1, 2, 301)] + [(1, "south"), (2, "south"), (8, "south"), (900, "alone")], key=repr)


@pytest.mark.parametrize("read", READERS)
@pytest.mark.parametrize("fault, pages", [
    ("answer gap: the page asked with cursor 0 announces cursor 5, the next page was asked with 9", [p for p in answer("gap", 0, 5, 9) if p["cursor"] != 5]),
    ("last page of a paged answer is missing: cursor 9", answer("gap", 0, 5, 9)[:-1]),
    ("first page is missing before the page asked with cursor 5", answer("gap", 0, 5, 9)[1:]),
    ("announces cursor 9, the next page was asked with 5", [*answer("gap", 0, 5, 9), answer("gap", 0, 5, 9)[1]]),
    ("cursor 9 ends the answer, but there is one with cursor 9", [*answer("gap", 0, 9), answer("gap", 0, 9)[1]]),
    ("cursor 9 ends the answer, but there is one with cursor 30", [*answer("gap", 0, 9), page([{"ID": 1}], answer="gap", cursor=30)]),
    ("announces more but no later cursor", [page([{"ID": 1}], True, 0, cursor=0)]),
    ("announces more but no later cursor", [page([{"ID": 1}], True, None), page([{"ID": 2}], cursor=5)]),
])
def test_an_answer_that_is_not_whole_fails(spark, tmp_path, read, fault, pages):
    path = land(tmp_path / "t", *answer("whole", 0, 3, 8), *pages)  # a finished answer does not hide an unfinished one
    with pytest.raises(PySparkException, match=fault):
        read(spark, path).select("ID").collect()


def test_only_headers_are_read_for_the_check(spark, tmp_path):
    path = land(tmp_path / "t", *answer("north", 0, 40))
    df = read_pages(spark, path, ddl(DDL)).select("ID")
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan json .*?ReadSchema: (struct<.*)", plan)
    assert {("data" in s, "cursor" in s) for s in scans} == {(True, False), (False, True)} and sum("data" in s for s in scans) == 1


def test_truncated_chunk_fails_even_when_only_one_column_is_used(spark, tmp_path):
    path = land(tmp_path / "t", page([{"ID": 1}]), page([{"ID": 2}], True))
    with pytest.raises(PySparkException, match="truncated"):
        read_pages(spark, path, ddl(DDL), whole_chunk=True).select("ID").collect()


@pytest.mark.parametrize("read", [
    lambda spark, path: read_pages(spark, path, ddl(DDL)),
    lambda spark, path: read_pages_with_defaults(spark, path, ddl(DDL), {"NOMBRE": "x"}),
    lambda spark, path: read_inferred_pages(spark, path),
])
def test_a_broken_page_is_never_read_as_no_rows(spark, tmp_path, read):
    good, broken = json.dumps(page([{"ID": 1}])), json.dumps(page([{"ID": 2}, {"ID": 3}]))[:-20]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "pages.json").write_text(good + "\n" + broken)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read(spark, str(tmp_path / "t")).collect()


def test_keys_in_another_case_are_found(spark, tmp_path):
    path = land(tmp_path / "t", page([{"id": 1, "Nombre": None}, {"id": 2}]))
    out = read_pages_with_defaults(spark, path, ddl(DDL), {"NOMBRE": "x"})
    assert rows(out, "ID", "NOMBRE") == [("1", None), ("2", "x")]


def test_names_of_a_row_are_turned_in_the_generator_only(spark, tmp_path):
    """every filter and cast that named a column turned the names of the whole row again."""
    path = land(tmp_path / "t", page([{"id": "1", "nombre": None, "Fecha": "2026-09-01"}, None, {"ID": 2, "fecha": "2026-09-02"}]), {"data": None}, {"data": []})
    out = read_pages_with_defaults(spark, path, ddl(DDL), {"NOMBRE": "x"}, "t")
    dated = require(type_rows(out.filter("FECHA >= DATE '2026-09-01' AND FECHA <= DATE '2026-09-01' OR ID = '2'"), ddl(DDL)), ["ID"])
    assert rows(out, "ID", "NOMBRE", "FECHA") == sorted([("1", None, "2026-09-01"), (None, "x", None), ("2", "x", "2026-09-02")], key=repr)
    assert [(r.ID, r.NOMBRE) for r in dated.orderBy("ID").collect()] == [(1, None), (2, "x")]
    plan = dated._jdf.queryExecution().optimizedPlan().toString().splitlines()
    turned = [line for line in plan if "transform_keys" in line]
    assert turned and all("Generate" in line or "size(" in line for line in turned)


def test_numbers_keep_every_digit(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "p.json").write_text('{"data":[{"ID":9007199254740993,"IMPORTE":12345678901234567.123456789}],"has_more":false}')
    out = type_rows(read_pages(spark, str(path), ddl(DDL)), ddl(DDL)).first()
    assert out.ID == 9007199254740993 and out.IMPORTE == Decimal("12345678901234567.123456789")


def test_typing_golden_cases(spark):
    raw = spark.createDataFrame(
        [("1", "BULTO      ", "123.4500", "2025-03-03T10:20:30", "2025-03-03T10:20:30", "x"), ("2", "   ", "", "", "", "x"),
         ("3", "\xa07501234567890\t ", " 1 ", "2025-03-03", "2025-03-03 00:00:00", "x")],
        "ID string, NOMBRE string, IMPORTE string, FECHA string, CREADO string, EXTRA string",
    )
    wide = ddl("ID BIGINT NOT NULL, NOMBRE STRING, IMPORTE DECIMAL(38,9), FECHA DATE, CREADO TIMESTAMP_NTZ, OTRO BIGINT")
    out = type_rows(raw, wide)
    assert out.columns == wide.names
    found = {r.ID: r for r in out.collect()}
    assert found[1].NOMBRE == "BULTO" and found[1].IMPORTE == Decimal("123.45") and found[1].FECHA == date(2025, 3, 3)
    assert found[1].CREADO == datetime(2025, 3, 3, 10, 20, 30) and found[1].OTRO is None
    assert tuple(found[2])[1:] == (None,) * 5
    assert found[3].NOMBRE == "7501234567890"


def test_bad_value_and_missing_required_value_fail(spark):
    raw = spark.createDataFrame([("1", "abc")], "ID string, IMPORTE string")
    with pytest.raises(PySparkException):
        type_rows(raw, ddl(DDL)).collect()
    with pytest.raises(PySparkException, match="required"):
        require(spark.createDataFrame([(None,)], "ID long"), ["ID"], "t").collect()


def test_finalise_adds_one_load_time(spark):
    raw = spark.createDataFrame([("1",), ("2",)], "ID string")
    schema = ddl("ID BIGINT NOT NULL, EMPRESA STRING NOT NULL, _synced_at TIMESTAMP NOT NULL")
    out = finalise(raw, schema, "E1", datetime(2026, 9, 10, 4, 0, 0)).collect()
    assert {(r.EMPRESA, r._synced_at) for r in out} == {("E1", out[0]._synced_at)}
    mexico = datetime(2026, 9, 9, 22, tzinfo=timezone(timedelta(hours=-6)))
    for zone in ("UTC", "America/Mexico_City"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        seconds = {finalise(raw, schema, "E1", at).selectExpr("unix_seconds(_synced_at)").first()[0] for at in (mexico, datetime(2026, 9, 10, 4))}
        assert seconds == {1789012800}
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert finalise(raw, None, "E1", datetime(2026, 9, 10)).schema["ID"].dataType.simpleString() == "string"


def write_rules(tmp_path, text):
    path = tmp_path / "rules.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_rules_sorted_with_booleans_bom_and_blank_rows(spark, tmp_path):
    path = write_rules(tmp_path, "﻿orden,PATRON,Formato,INCLUIR\n20,B,Dos,no\n10,A,Uno,Si\n,,,\n")
    assert [tuple(r) for r in read_rules(spark, path).select("ORDEN", "PATRON", "FORMATO", "INCLUIR").collect()] == [
        (10, "A", "Uno", True), (20, "B", "Dos", False),
    ]


@pytest.mark.parametrize(
    "text, reason",
    [
        ("ORDEN,PATRON,FORMATO,INCLUIR\n10,(abc,Uno,si\n", "valid pattern"),
        ("ORDEN,PATRON\n10,A\n", "lacks column"),
        ("ORDEN,PATRON,FORMATO,INCLUIR\n10,A,Uno,maybe\n", "boolean"),
        ("ORDEN,PATRON,FORMATO,INCLUIR\nx,A,Uno,si\n", "integer"),
        ("ORDEN,PATRON,FORMATO,INCLUIR\n1,A, ,si\n", "FORMATO"),
        ("ORDEN,PATRON,FORMATO,INCLUIR\n,,,\n", "no rules"),
    ],
)
def test_bad_rule_files(spark, tmp_path, text, reason):
    with pytest.raises(RuleFileError, match=reason):
        read_rules(spark, write_rules(tmp_path, text))


def test_tagged_union(spark):
    feeds = {tipo: spark.createDataFrame([(i,)], "DOCTO_VE_ID long") for i, tipo in enumerate(SALES_FEEDS.values())}
    assert [r[1] for r in rows(tagged_union(feeds), "DOCTO_VE_ID", "TIPO_DOCTO")] == ["F", "R", "P", "C", "D"]


def test_type_is_set_only_where_the_key_is_absent(spark, tmp_path):
    schema = ddl("DOCTO_VE_ID BIGINT NOT NULL, TIPO_DOCTO STRING, FECHA DATE NOT NULL")
    path = land(tmp_path / "t", page([{"DOCTO_VE_ID": 1}, {"DOCTO_VE_ID": 2, "TIPO_DOCTO": None}, {"DOCTO_VE_ID": 3, "TIPO_DOCTO": "Q"}]))
    out = read_pages_with_defaults(spark, path, schema, {"TIPO_DOCTO": "F"})
    assert rows(out, "DOCTO_VE_ID", "TIPO_DOCTO") == [("1", "F"), ("2", None), ("3", "Q")]


def test_month_delta_opening_and_snapshot(spark):
    delta = month_delta(spark.createDataFrame([(1,)], "ARTICULO_ID long"), date(2026, 7, 15)).first()
    assert delta.PERIODO == date(2026, 7, 1) and delta.ES_SALDO_INICIAL is False
    balance = spark.createDataFrame([(1, 2, Decimal(5), Decimal(50))], "ARTICULO_ID long, ALMACEN_ID long, EXISTENCIA decimal(38,9), COSTO decimal(38,9)")
    o = opening_balance(balance, date(2026, 6, 1)).first()
    assert (o.PERIODO, o.ENTRADAS_UNIDADES, o.SALIDAS_UNIDADES, o.ULTIMO_DIA, o.ES_SALDO_INICIAL) == (date(2026, 6, 1), 5, 0, 30, True)
    assert snapshot_of(balance, date(2026, 9, 10)).first()._snapshot_date == date(2026, 9, 10)


def test_inferred_catalog(spark, tmp_path):
    path = land(tmp_path / "t", page([{"ZONA_ID": 31, "NOMBRE": "Costa "}]), page([{"ZONA_ID": 32, "NOMBRE": None, "RUTA": 0.25, "NOTA": None}]))
    out = read_inferred_pages(spark, path)
    assert dict(out.dtypes) == {"ZONA_ID": "bigint", "NOMBRE": "string", "RUTA": "decimal(38,9)", "NOTA": "string"}
    assert out.count() == 2


@pytest.mark.parametrize("pages", [[page([])], [page(None)], [{"has_more": False}], [page(None), page([])]])
def test_pages_without_rows_have_nothing_to_infer(spark, tmp_path, pages):
    path = land(tmp_path / "e", *pages)
    assert read_inferred_pages(spark, path).columns == []
    assert read_inferred_pages(spark, path, before=ddl("A BIGINT")).dtypes == [("A", "bigint")]


def test_inferred_types_agree_from_night_to_night(spark, tmp_path):
    before = ddl("A BIGINT, B DECIMAL(38,9), C STRING, D BOOLEAN, E BIGINT, GONE STRING, F BIGINT")
    path = land(tmp_path / "t", page([{"a": 1.5, "B": 7, "C": 5, "D": None, "E": "x7", "F": 8, "NEW": True}]), page([{"a": 2.123456789}]))
    out = read_inferred_pages(spark, path, before=before)
    assert dict(out.dtypes) == {"a": "decimal(38,9)", "B": "decimal(38,9)", "C": "string", "D": "boolean", "E": "string", "F": "bigint", "NEW": "boolean"}
    assert [tuple(str(r[c]) for c in ("a", "B", "C", "E")) for r in out.filter("B IS NOT NULL").collect()] == [("1.500000000", "7.000000000", "5", "x7")]
    assert out.filter("a > 2").first()["a"] == Decimal("2.123456789")


@pytest.mark.parametrize("old, value", [("BOOLEAN", 3), ("BOOLEAN", "yes"), ("BIGINT", True), ("STRUCT<x: BIGINT>", 1), ("STRING", [1])])
def test_other_changes_of_type_are_refused(spark, tmp_path, old, value):
    with pytest.raises(InferredTypes, match="zonas: A was"):
        read_inferred_pages(spark, land(tmp_path / "t", page([{"A": value}])), table="zonas", before=ddl(f"A {old}"))


def test_landed_rows_are_dealt_once_and_written_compressed(spark, tmp_path):
    from checks.ingest import land, landed_pages

    rows_in = spark.range(0, 20_000, 7).select(F.col("id").alias("ID"), F.lit("x").alias("X"))
    assert landed_pages(rows_in, "ID")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    folder = tmp_path / "landed"
    land(rows_in, "ID", str(folder))
    assert {f.suffixes[-1] for f in folder.glob("part-*")} == {".gz"}
    back = read_pages(spark, str(folder), T.StructType.fromDDL("ID BIGINT, X STRING"), False, "t")
    assert sorted(int(r["ID"]) for r in back.collect()) == list(range(0, 20_000, 7))
