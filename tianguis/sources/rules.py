"""The sales-channel rule file."""

from __future__ import annotations

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import strip

# Accepted spellings of the include flag.
TRUE_WORDS = ["true", "1", "si", "sí", "s", "yes", "y", "t"]
FALSE_WORDS = ["false", "0", "no", "n", "f", ""]
HEADER = ["ORDEN", "PATRON", "FORMATO", "INCLUIR"]


class RuleFileError(RuntimeError):
    """The rule file must not be loaded."""


def rejected_patterns(rows: DataFrame) -> list[str]:
    """The patterns that the plans' own matcher cannot compile. A rule file is small by definition."""
    compiler = rows.sparkSession._jvm.java.util.regex.Pattern
    bad = []
    for pattern in [r.PATRON for r in rows.select("PATRON").distinct().collect()]:
        try:
            compiler.compile("(?iu)" + pattern)
        except IllegalArgumentException:
            bad.append(pattern)
    return bad


def include_flag(c: Column) -> Column:
    word = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def check_rules(raw: DataFrame) -> DataFrame:
    """Typed rule rows with ``reason``: NULL for a good row, else why it is rejected.

    ``raw`` holds the file as text. Rows without a pattern are skipped, not rejected.
    """
    by_name = {c.replace("\ufeff", "").strip().upper(): c for c in raw.columns}
    missing = [c for c in HEADER if c not in by_name]
    if missing:
        raise RuleFileError(f"rule file lacks column {', '.join(missing)}")
    text = raw.select(*[F.coalesce(F.col(f"`{by_name[c]}`"), F.lit("")).alias(c) for c in HEADER])
    rows = text.select(
        strip(F.col("ORDEN")).try_cast("bigint").alias("ORDEN"),
        strip(F.col("PATRON")).alias("PATRON"),
        strip(F.col("FORMATO")).alias("FORMATO"),
        include_flag(F.col("INCLUIR")).alias("INCLUIR"),
    ).filter(F.col("PATRON") != "")
    reason = (
        F.when(F.col("ORDEN").isNull(), "ORDEN is not an integer")
        .when(F.col("PATRON").isin(rejected_patterns(rows)), "PATRON is not a valid pattern")
        .when(F.col("FORMATO") == "", "FORMATO is empty")
        .when(F.col("INCLUIR").isNull(), "INCLUIR is not a boolean")
    )
    return rows.withColumn("reason", reason)


def good_rules(raw: DataFrame) -> DataFrame:
    return check_rules(raw).filter(F.col("reason").isNull()).drop("reason").orderBy("ORDEN")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a CSV file, sorted; raises if any row is rejected or none is left."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    checked = check_rules(raw)
    bad = checked.filter(F.col("reason").isNotNull()).limit(5).collect()
    if bad:
        raise RuleFileError("; ".join(f"ORDEN={r.ORDEN} PATRON={r.PATRON!r}: {r.reason}" for r in bad))
    rules = checked.drop("reason").orderBy("ORDEN")
    if rules.isEmpty():
        raise RuleFileError(f"{path}: no rules")
    return rules
