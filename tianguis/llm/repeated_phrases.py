"""Removal of repeated passages of words: sharded Aho-Corasick automata of the phrases that recur."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, groupby

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tianguis.llm.periodic_runs import Numbers
from tianguis.llm.staging import Scratch
from tianguis.llm.suffix_dedup import Powers, _merged, _mixed, _pairs, _sliding_min

WINDOW = 20
#: Words of the anchors by which windows are dealt to shards.
ANCHOR = 4
#: An automaton is made of whole anchors of at most so many words, or of one anchor; the windows of an anchor of more than the
#: second are dealt out one by one.
SHARD_WORDS = 40_000
MAX_ANCHOR_WORDS = 80_000
#: Bytes and words of text that a worker hashes at a time; longer texts are hashed in parts.
BYTES_AT_ONCE = 1 << 20
WORDS_AT_ONCE = 1 << 18

_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_SPACE_PATTERN = re.compile(rb"[\x20\x09-\x0D]")
_LETTERS = np.random.default_rng(12).integers(0, 2**64, 256, np.uint64)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Places within a part, in the low bits of a key; parts have fewer words.
_PLACES = np.uint64((1 << 24) - 1)
_POWERS = Powers()

RANGES = "array<struct<a:long,b:long>>"
_RANGE_TYPE = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, a stretch without the six white spaces of ASCII."""
    parts, at = [], 0
    while at < len(text):
        cut = _SPACE_PATTERN.search(text, min(at + BYTES_AT_ONCE, len(text)))
        end = cut.start() if cut else len(text)
        data = np.frombuffer(text, np.uint8, end - at, at)
        n = len(data)
        _POWERS.grow(n + 1)
        edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]])))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[data] * _POWERS.up[:n], out=sums[1:])
        parts.append(_mixed((sums[ends] - sums[starts]) * _POWERS.down[starts]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` consecutive words."""
    n = len(words) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        h = h * _MULTIPLIER + words[k : n + k]
    return _mixed(h)


def anchored_windows(words: np.ndarray, text: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Start, number of windows, anchor hash and content hash of the stretches of windows that share an anchor.

    `words` are hashes, `text` tells the text of each. The anchor of a window is the leftmost of its `anchor`-word parts with
    the smallest hash, so equal windows have equal anchors at equal offsets. A stretch is as long as its windows have the same
    anchor at the same place; every window of a text is in one stretch, and the windows of a stretch differ from each other.
    Its content are all words of its windows.
    """
    n = len(words) - window + 1
    if n < 1:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    grams = _rolled(words, anchor)
    keys = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
    places = (_sliding_min(keys, window - anchor + 1) & _PLACES).astype(np.int64)
    whole = text[:n] == text[window - 1 :]
    fresh = np.concatenate([[True], (places[1:] != places[:-1]) | (text[1:n] != text[: n - 1]) | (whole[1:] != whole[:-1])])
    begins = np.flatnonzero(fresh)
    ends = np.concatenate([begins[1:], [n]])
    starts, sizes = begins[whole[begins]], (ends - begins)[whole[begins]]
    _POWERS.grow(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _POWERS.up[: len(words)], out=sums[1:])
    content = (sums[starts + sizes + window - 1] - sums[starts]) * _POWERS.down[starts] + sizes.astype(np.uint64)
    return starts, sizes, grams[places[starts]], _mixed(content)


def _parts(texts: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Texts as word hashes: number of the text, first word and hashes, in groups of about `WORDS_AT_ONCE` words.

    A longer text is cut into parts that overlap by all but one word of a window, so each window lies in one part.
    """
    numbers, firsts, arrays, size = [], [], [], 0
    for number, text in enumerate(texts):
        words = word_hashes(text)
        for first in range(0, max(len(words) - window + 1, 0), WORDS_AT_ONCE):
            part = words[first : first + WORDS_AT_ONCE + window - 1]
            if arrays and size + len(part) > WORDS_AT_ONCE:
                yield numbers, firsts, arrays
                numbers, firsts, arrays, size = [], [], [], 0
            numbers.append(number)
            firsts.append(first)
            arrays.append(part)
            size += len(part)
    if arrays:
        yield numbers, firsts, arrays


def _flags(edges: np.ndarray) -> list[dict[str, int]]:
    """Ranges of true entries."""
    at = np.flatnonzero(np.diff(np.concatenate([[False], edges, [False]]))).tolist()
    return [{"a": a, "b": b} for a, b in zip(at[::2], at[1::2])]


class Shard:
    """The automaton of the phrases that recur among some lines of text.

    A line is (number of times it occurs, place, words), where a place (document, word) tells its first occurrence; lines
    differ from each other. Windows that several lines or several places of one line hold are phrases of their own; of a
    line that occurs more than once, each stretch of the other windows is one phrase. Hashes only choose the phrases; what
    is found are the words themselves.
    """

    def __init__(self, lines: list[tuple[int, tuple, list[bytes]]], window: int = WINDOW):
        self.window, self.lines = window, lines
        numbers = Numbers()
        self.ids = [tuple(map(numbers.__getitem__, words)) for _, _, words in lines]
        # Places as whole numbers: the rank of the document, then the word.
        rank = {doc: n << 40 for n, doc in enumerate(sorted({doc for _, (doc, _), _ in lines}))}
        self.places = [rank[doc] + start for _, (doc, start), _ in lines]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.sizes: list[int] = []
        self._compile()

    def _compile(self) -> None:
        sizes = np.array([len(ids) for ids in self.ids])
        begins = np.cumsum(sizes) - sizes
        line = np.repeat(np.arange(len(sizes)), sizes)
        hashes = _rolled(np.fromiter(chain.from_iterable(self.ids), np.uint64, int(sizes.sum())) + np.uint64(1), self.window)
        whole = line[: len(hashes)] == line[self.window - 1 :]
        _, kind, count = np.unique(hashes[whole], return_inverse=True, return_counts=True)
        common = np.zeros(len(hashes), bool)
        common[whole] = count[kind] > 1
        for (times, _, _), ids, begin in zip(self.lines, self.ids, begins.tolist()):
            windows = common[begin : begin + len(ids) - self.window + 1]
            for at in np.flatnonzero(windows).tolist():
                self._add(ids[at : at + self.window])
            if times > 1:
                for own in _flags(~windows):
                    self._add(ids[own["a"] : own["b"] + self.window - 1])
        if self.sizes:
            self.automaton.make_automaton()

    def _add(self, phrase: tuple[int, ...]) -> None:
        if not self.automaton.exists(phrase):
            self.automaton.add_word(phrase, len(self.sizes))
            self.sizes.append(len(phrase))

    def located(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each line, which of its windows lie in a phrase, and which of these in one that occurs at an earlier place."""
        hits: list[list[tuple[int, int]]] = [[] for _ in self.lines]
        sizes, first = self.sizes, [1 << 62] * len(self.sizes)
        for found, place, ids in zip(hits if sizes else (), self.places, self.ids):
            for end, phrase in self.automaton.iter(ids):
                at = end + 1 - sizes[phrase]
                found.append((at, phrase))
                if place + at < first[phrase]:
                    first[phrase] = place + at
        for found, place, ids in zip(hits, self.places, self.ids):
            inside, later = bytearray(len(ids) - self.window + 1), bytearray(len(ids) - self.window + 1)
            for at, phrase in found:
                windows = sizes[phrase] - self.window + 1
                inside[at : at + windows] = b"\1" * windows
                if place + at > first[phrase]:
                    later[at : at + windows] = b"\1" * windows
            yield np.frombuffer(inside, bool), np.frombuffer(later, bool)


def _settled(lines: list[dict], window: int, doc_id: pa.DataType) -> pa.RecordBatch:
    """Of lines with anchor, content, times, doc_id, start and words: the ranges of windows that recur, and that come later."""
    shard = Shard([(r["times"], ((r["doc_id"] is not None, r["doc_id"]), r["start"]), r["words"].split()) for r in lines], window)
    keep, recur, later = [], [], []
    for row, (inside, after) in zip(lines, shard.located()):
        if inside.any():
            keep.append(row)
            recur.append(_flags(inside))
            later.append(_flags(after))
    columns = [pa.array([r[c] for r in keep], kind) for c, kind in (("anchor", pa.int64()), ("content", pa.int64()), ("doc_id", doc_id), ("start", pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(recur, _RANGE_TYPE), pa.array(later, _RANGE_TYPE)], ["anchor", "content", "doc_id", "start", "recur", "later"]
    )


def _settle(lines: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Which windows recur and come later, of the lines in which some do; an anchor's lines come to one shard, one after the other."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def rows() -> Iterator[dict]:
            for batch in batches:
                kinds[:] = [batch.schema.field("doc_id").type]
                yield from batch.set_column(0, "words", batch.column(0).cast(pa.binary())).to_pylist()

        held: list[dict] = []
        size = 0
        for _, group in groupby(rows(), key=lambda r: r["anchor"]):
            some = list(group)
            more = sum(r["size"] for r in some)
            if held and size + more > shard_words:
                yield _settled(held, window, *kinds)
                held, size = [], 0
            held += some
            size += more
        if held:
            yield _settled(held, window, *kinds)

    dealt = lines.select("words", "size", "anchor", "content", "times", "doc_id", "start").repartition("anchor").sortWithinPartitions("anchor")
    kind = T.StructType(
        [*T.StructType.fromDDL("anchor long, content long").fields, lines.schema["doc_id"], *T.StructType.fromDDL(f"start long, recur {RANGES}, later {RANGES}").fields]
    )
    return dealt.mapInArrow(settle, kind)


def _same_row(a: Column, b: Column) -> Column:
    """True; an error if the input has given other rows when it was read again."""
    return F.when(a.eqNullSafe(b), True).otherwise(F.raise_error(F.lit("the input gives other rows when it is read again")).cast("boolean"))


def repeated_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    shard_words: int = SHARD_WORDS,
    max_anchor_words: int = MAX_ANCHOR_WORDS,
) -> DataFrame:
    """One row per input row: doc_id, text, spans; spans are the maximal ranges of words (a, b) covered by later passages.

    A window is `window` consecutive words of one text. It is later if the same words also start at a smaller place, that is
    in a text with a smaller id, or in a text with the same id at an earlier word; a null id is the smallest. So rows that
    repeat with the same id and the same text are not later than each other, and of a passage that recurs the first place
    stays whole. Null and empty texts, and those with fewer words, have no spans. Columns besides the two, whatever their
    names, are not read; an empty table gives an empty one. The input has to give the same rows in the same places when it is
    read again, as files do; otherwise the job fails.

    Windows are dealt out by anchors, which equal windows share. A count leaves those whose anchor occurs again. Equal
    stretches of windows become one line with a count and their first place before any words move, so a group of copies of
    any size is one line. The lines of each anchor come to one shard, whose automaton holds the phrases confirmed to recur
    and locates every occurrence in the lines streamed through it: each text passes as its lines through the automata that can
    match, and through no other. The lines of an anchor of more than `max_anchor_words` are cut into single windows, summed
    up, and dealt out by the words of the whole window instead.
    """
    spark = df.sparkSession
    texts = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, firsts, arrays in _parts(batch.column(2).cast(pa.binary()).to_pylist(), window):
                sizes = np.array([len(a) for a in arrays])
                owner = np.repeat(np.arange(len(arrays)), sizes)
                starts, counts, anchors, contents = anchored_windows(np.concatenate(arrays), owner, window, anchor)
                part = owner[starts]
                own = np.array(numbers)[part]
                start = starts - (np.cumsum(sizes) - sizes)[part] + np.array(firsts)[part]
                columns = [pa.array(c.view(np.int64)) for c in (start, anchors, contents)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), columns[0], pa.array(counts.astype(np.int32)), *columns[1:]],
                    ["doc_id", "place", "start", "windows", "anchor", "content"],
                )

    kind = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL("place long, start long, windows int, anchor long, content long").fields])
    found = texts.mapInArrow(stretches, kind)
    scratch = Scratch(spark, "passages")
    # The anchors that recur are written first: a join with a table read again can be split where one key is frequent.
    again = scratch.staged(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")
    kept = scratch.staged(found.join(again, "anchor"), "stretches")
    scratch.drop("anchors")
    contents = scratch.staged(
        kept.groupBy("anchor", "content")
        .agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "start", "place", "windows")).alias("at"))
        .select("anchor", "content", "times", "at.*"),
        "contents",
    )
    words = F.sum(F.col("windows") + F.lit(window - 1))
    hot = contents.groupBy("anchor").agg(words.alias("words")).filter(F.col("words") > max_anchor_words).select("anchor", F.lit(True).alias("hot"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                words = batch.column(0)[at].cast(pa.binary()).as_py().split()
                rows = batch.column(1)[at].as_py()
                lines = [b" ".join(words[r["start"] : r["start"] + r["windows"] + window - 1]) for r in rows]
                columns = [pa.array([r[c] for r in rows], pa.int64()) for c in ("anchor", "content", "times")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["hot"] for r in rows], pa.bool_()),
                        *columns,
                        pa.repeat(batch.column(2)[at], len(rows)),
                        pa.array([r["start"] for r in rows], pa.int64()),
                        pa.array([r["windows"] + window - 1 for r in rows], pa.int64()),
                        pa.array(lines, pa.binary()).cast(pa.string()),
                    ],
                    ["hot", "anchor", "content", "times", "doc_id", "start", "size", "words"],
                )

    line = T.StructType(
        [
            *T.StructType.fromDDL("hot boolean, anchor long, content long, times long").fields,
            texts.schema["doc_id"],
            *T.StructType.fromDDL("start long, size long, words string").fields,
        ]
    )

    # The words of contents are cut out of the text in which each occurs first.
    stretch = F.struct(F.coalesce("hot", F.lit(False)).alias("hot"), "anchor", "content", "times", "start", F.col("windows").cast("long").alias("windows"))
    by_text = contents.join(hot, "anchor", "left").groupBy("place").agg(F.first("doc_id").alias("own"), F.collect_list(stretch).alias("runs"))
    joined = texts.join(by_text, "place").filter(_same_row(F.col("doc_id"), F.col("own")))
    lines = scratch.staged(joined.select("text", "runs", "doc_id").mapInArrow(cut, line), "lines")
    scratch.drop("contents")
    results = _settle(lines.filter("not hot"), window, shard_words)
    if not lines.filter("hot").isEmpty():
        results = results.unionByName(_one_by_one(lines.filter("hot"), scratch, window, shard_words))
    results = scratch.staged(results, "located")
    scratch.drop("lines", "windows", "recurring")

    first = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("start") == F.col("own_start"))
    removed = (
        kept.join(results.withColumnRenamed("doc_id", "own").withColumnRenamed("start", "own_start"), ["anchor", "content"])
        .select("place", "doc_id", "start", F.explode(F.when(first, F.col("later")).otherwise(F.col("recur"))).alias("r"))
        .groupBy("place")
        .agg(
            F.first("doc_id").alias("own"),
            F.collect_list(F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + window - 1).alias("b"))).alias("found"),
        )
    )
    merge = F.pandas_udf(lambda c: pd.Series([[{"a": a, "b": b} for a, b in _merged(_pairs(v))] for v in c], dtype=object), RANGES)
    joined = texts.join(removed, "place", "left").filter(F.col("found").isNull() | _same_row(F.col("doc_id"), F.col("own")))
    return joined.select("doc_id", "text", merge("found").alias("spans"))


def _one_by_one(lines: DataFrame, scratch: Scratch, window: int, shard_words: int) -> DataFrame:
    """Like `_settle`, of lines cut into windows that are summed up and dealt out by all their words.

    A window is one line however many contents hold it, so no shard has more than its even part.
    """

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, line in enumerate(batch.column(0).cast(pa.binary()).to_pylist()):
                words = line.split()
                parts = [b" ".join(words[k : k + window]) for k in range(len(words) - window + 1)]
                index = pa.array([at] * len(parts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(index) for c in range(1, batch.num_columns)],
                        pa.array(range(len(parts)), pa.int64()),
                        pa.array(parts, pa.binary()).cast(pa.string()),
                    ],
                    [*batch.schema.names[1:], "offset", "words"],
                )

    given = lines.select("words", "anchor", "content", "times", "doc_id", "start")
    cut = given.mapInArrow(windows_of, T.StructType([*given.schema.fields[1:], *T.StructType.fromDDL("offset long, words string").fields]))
    hashed = lambda seed: F.xxhash64(F.lit(seed), "words")
    place = F.struct("doc_id", (F.col("start") + F.col("offset")).alias("start"))
    single = scratch.staged(cut.withColumns({"w": hashed(1), "v": hashed(2), "place": place}), "windows")
    summed = (
        single.groupBy("w", "v", "words")
        .agg(F.sum("times").alias("times"), F.min("place").alias("at"))
        .select(F.col("w").alias("anchor"), F.col("v").alias("content"), "times", "at.*", F.lit(window).cast("long").alias("size"), "words")
    )
    located = _settle(summed, window, shard_words)
    recurring = scratch.staged(located.select(F.col("anchor").alias("w"), F.col("content").alias("v"), F.struct("doc_id", "start").alias("at")), "recurring")
    own = F.struct(F.col("offset").alias("a"), (F.col("offset") + 1).alias("b"))
    return (
        single.join(recurring, ["w", "v"])
        .groupBy("anchor", "content")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("start").alias("start"),
            F.sort_array(F.collect_list(own)).alias("recur"),
            F.sort_array(F.collect_list(F.when(F.col("place") > F.col("at"), own))).alias("later"),
        )
    )


def passage_digests(spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by one space, from texts and their spans."""

    def digest(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(texts, spans):
            words = text.encode().split()
            kept, gone = _without(words, found)
            rows.append((len(words), gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    made = F.pandas_udf(digest, "n_words long, n_removed long, kept_sha256 string")("text", "spans")
    return spans.select("doc_id", made.alias("d")).select("doc_id", "d.*")


def _without(words: list[bytes], spans) -> tuple[list[bytes], int]:
    """The words outside the spans, and the number of the others."""
    kept, at, gone = [], 0, 0
    for a, b in _pairs(spans).tolist():
        kept += words[at:a]
        at, gone = b, gone + b - a
    return kept + words[at:], gone


def without_passages(spans: DataFrame) -> DataFrame:
    """doc_id and the text: kept words joined by one space where something was removed, the text as it was elsewhere."""

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(_without(t.encode().split(), s)[0]).decode() if len(s) else t for t, s in zip(texts, spans)], dtype=object)

    return spans.select("doc_id", F.pandas_udf(cut, "string")("text", "spans").alias("text"))
