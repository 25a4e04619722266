"""The corpus pipeline: quality rules, exact duplicates, near duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`. What a stage has staged for itself is dropped when the next
one begins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tianguis.llm.exact_dedup import exact_duplicates
from tianguis.llm.near_dedup import near_duplicates
from tianguis.llm.packing import pack_documents, sequence_pieces
from tianguis.llm.quality_rules import quality_rules as judged
from tianguis.llm.secrets import redacted, secret_spans
from tianguis.llm.staging import Scratch, dropped_before


def stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that begins by dropping what the stages before have staged."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with dropped_before(docs):
            return function(spark, docs, sf_dir)

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return judged(docs, carry=True).filter("kept").select("row.*")


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_duplicates(docs, carry=True).filter("kept").select("row.*")


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are linked, directly or through others, the row with the smallest id stays."""
    return near_duplicates(docs, carry=True).filter("kept").select("row.*")


@stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans that hold secrets are replaced by a mark, and the length is counted again."""
    found = secret_spans(docs, carry=True).select("row.*", "spans")
    clean = found.withColumn("text", redacted(found))
    changed = F.size("spans") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its token ids, its sequence and its place there."""
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return sequence_pieces(packed).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: Shingle links, spans by regular expressions with code points, token ids and bins are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline"), None
    for name, step in STAGES[:-1]:
        docs = scratch.staged(step(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
