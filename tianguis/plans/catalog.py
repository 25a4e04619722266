"""V11 item codes, V12 customer type -> sales channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import strip
from ..model import Tables
from .dims import ITEM

# Role of an alternate code, shape of a barcode, default channel.
ALTERNATE_ROLE = "CLAVE ALTERNA"
BARCODE = r"^[0-9]{12,14}\z"
DEFAULT_CHANNEL = "Otros"


def item_codes(t: Tables) -> DataFrame:
    """Main code, barcode and first alternate of every item that has a non-blank code."""
    code = strip(F.col("CLAVE_ARTICULO"))
    rows = t["dim_articulo_claves"].select(
        *ITEM,
        "CLAVE_ARTICULO_ID",
        code.alias("CODIGO"),
        (F.col("ES_PPAL") == "S").alias("principal"),
        (F.upper(strip(F.col("ROL"))) == ALTERNATE_ROLE).alias("alterna"),
        F.when(F.col("ES_GTIN") == "S", 0).otherwise(1).alias("gtin"),
    ).filter(F.col("CODIGO") != "")  # also drops NULL codes

    def first_code(test: Column, *order: str) -> Column:
        return F.min(F.when(test, F.struct(*order, "CODIGO")))["CODIGO"]

    is_alternate = F.col("alterna")
    # One pass picks all three: no self-joins, and a hot item combines before the shuffle.
    return rows.groupBy(*ITEM).agg(
        first_code(F.col("principal"), "CLAVE_ARTICULO_ID").alias("CLAVE_PRINCIPAL"),
        first_code(is_alternate & F.col("CODIGO").rlike(BARCODE), "gtin", "CLAVE_ARTICULO_ID").alias("CODIGO_BARRAS"),
        first_code(is_alternate, "CLAVE_ARTICULO_ID").alias("CLAVE_ALTERNA"),
    )


def match_channel(types: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``_regla``: the matching rule of lowest ORDEN, or NULL.

    The rules, a small file by definition, are a scalar of the plan: an array by company, in
    order. Each type takes the first that matches, so types that repeat or have no id are
    judged like any other, and nothing is joined.
    """
    rule = F.struct("ORDEN", "PATRON", "FORMATO", "INCLUIR")
    listed = rules.filter(F.col("EMPRESA").isNotNull()).groupBy("EMPRESA").agg(F.sort_array(F.collect_set(rule)).alias("_reglas"))
    by_company = listed.agg(F.map_from_entries(F.collect_list(F.struct("EMPRESA", "_reglas")))).scalar()
    matching = F.filter("_reglas", lambda r: F.rlike(strip(F.col("NOMBRE")), F.concat(F.lit("(?iu)"), r["PATRON"])))
    own = F.try_element_at(by_company, F.col("EMPRESA"))
    return types.withColumn("_reglas", own).withColumn("_regla", F.get(matching, F.lit(0))).drop("_reglas")


def customer_type_channels(t: Tables, with_company: bool = False) -> DataFrame:
    """One row per customer type: zone, channel, include flag and the rule that decided.

    Matching ignores case by a regex flag. Upper-casing the pattern instead would turn
    ``\\s`` and ``\\d`` into their opposites and miss the names the rules were written for.
    """
    r = F.col("_regla")
    types = t["dim_tipos_clientes"].select("EMPRESA", F.col("TIPO_CLIENTE_ID").cast("bigint").alias("TIPO_CLIENTE_ID"), "NOMBRE")
    out = match_channel(types, t["dim_formato_venta"]).select(
        "EMPRESA",
        "TIPO_CLIENTE_ID",
        strip(F.col("NOMBRE")).alias("ZONA"),
        F.coalesce(r["FORMATO"], F.lit(DEFAULT_CHANNEL)).alias("FORMATO"),
        F.coalesce(r["INCLUIR"], F.lit(True)).alias("INCLUIR"),
        r["ORDEN"].alias("ORDEN_REGLA"),
        r["PATRON"].alias("PATRON_REGLA"),
    )
    return out if with_company else out.drop("EMPRESA")
