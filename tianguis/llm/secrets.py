"""Secret scans with corpus-wide ownership frequency."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.llm.staging import staged

#: Kinds in the order in which spans with equal starts are listed; all but the last are always kept.
KINDS = ["assign", "access", "hex", "token"]
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX, MIN_TOKEN = 12, 18, 16, 24
MIN_TOKEN_BITS = 3.5
#: A value found with more owners or in more repositories than this is a copied example.
MAX_OWNERS = 3
MAX_REPOSITORIES = 6


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


ASSIGN = re.compile(f"({_either_case('password|passwd|secret|token|api_?key')})" r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of a class are maximal, so asking for the length in the pattern finds the same runs as dropping short ones.
HEX = re.compile(f"[0-9a-f]{{{MIN_HEX},}}")
TOKEN = re.compile(f"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}")


def _bits(value: str) -> float:
    """Shannon entropy per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start and kind; candidates of kind `token` never touch a span of another kind."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    tokens, at, reached = [], 0, 0
    for m in TOKEN.finditer(text):
        start, end = m.span()
        while at < len(found) and found[at][1] < end:
            reached = max(reached, found[at][2])
            at += 1
        value = m[0]
        mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
        if reached <= start and mixed and _bits(value) >= MIN_TOKEN_BITS:
            tokens.append(("token", start, end, value))
    return sorted(found + tokens, key=lambda s: (s[1], KINDS.index(s[0])))


def _candidates(text: Column) -> Column:
    digest = lambda value: hashlib.sha256(value.encode()).hexdigest()[:32]

    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: [{"start": s, "rank": KINDS.index(k), "end": e, "value_hash": digest(v)} for k, s, e, v in find_spans(t)]
        )

    return F.pandas_udf(scan, "array<struct<start:long,rank:int,end:long,value_hash:string>>")(text)


def secret_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_cols: tuple[str, ...] = ("source", "lang"),
    carry: bool = False,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per input row: doc_id and spans, an array of (start, rank, end, value_hash, owners, repositories, live).

    Offsets are code points, `rank` is the place in KINDS. Every candidate's value hash is counted over the corpus by
    distinct owners and repositories; a value that more of them share than allowed is a copied example, any other is
    live. Spans of the base kinds stay either way, marked; a `token` candidate becomes a span only if it is live.
    Null text counts as empty; a null owner counts as one owner; a document without spans has an empty array.

    One pass finds candidates and stages them (`row`, the input row, with them if asked). Counting first reduces to
    distinct (value, owner, repository), so a value that a third of all rows hold arrives as a few lines per task.
    """
    carried = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    owner = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    scanned = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        owner(owner_col).alias("owner"),
        F.concat_ws("/", *[owner(c) for c in repository_cols]).alias("repository"),
        F.monotonically_increasing_id().alias("place"),
        _candidates(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("found"),
        *carried,
    )
    scanned = staged(scanned, "secrets")
    single = scanned.select("place", "owner", "repository", F.explode("found").alias("span"))
    owned = (
        single.select("span.value_hash", "owner", "repository")
        .distinct()
        .groupBy("value_hash")
        .agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories"))
    )
    judged = single.withColumn("value_hash", F.col("span.value_hash")).join(owned, "value_hash")
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    per_row = (
        judged.withColumn("live", live)
        .filter(F.col("live") | (F.col("span.rank") < len(KINDS) - 1))
        .groupBy("place")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("span.start", "span.rank", "span.end", "value_hash", "owners", "repositories", "live"))
            ).alias("spans")
        )
    )
    nothing = F.array().cast(per_row.schema["spans"].dataType)
    columns = ["doc_id", "spans", *(["row"] if carry else [])]
    # Rows without a candidate, by far the most, need no shuffle.
    some = scanned.filter(F.size("found") > 0).join(per_row, "place", "left").withColumn("spans", F.coalesce("spans", nothing))
    none = scanned.filter(F.size("found") == 0).withColumn("spans", nothing)
    return some.select(*columns).unionByName(none.select(*columns))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(KINDS) - 1)


def redacted(df: DataFrame, text_col: str = "text", spans_col: str = "spans", mark: str = "[SECRET]") -> Column:
    """The text with every run of spans that touch or overlap replaced by one mark."""

    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            yield pd.Series([_cut(t, s, mark) for t, s in zip(texts, spans)], dtype=object)

    return F.pandas_udf(cut, "string")(F.col(text_col), F.col(spans_col))


def _cut(text: str | None, spans, mark: str) -> str | None:
    if text is None or len(spans) == 0:
        return text
    parts, at = [], 0
    for span in spans:
        if span["start"] > at or not parts:
            parts += [text[at : span["start"]], mark]
        at = max(at, span["end"])
    return "".join(parts) + text[at:]
