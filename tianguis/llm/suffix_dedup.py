"""Removal of repeated byte strings: blocks of equal anchors, and a Burrows-Wheeler transform in each block."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.staging import staged

LENGTH = 200
#: Length of the anchors by which strings are dealt to blocks.
ANCHOR = 64
#: A block holds whole anchors of at most so many bytes, or one anchor; one of more than the second is settled string by
#: string.
BLOCK_BYTES = 1 << 20
MAX_ANCHOR_BYTES = 2 << 20

_SEED = 2
_RNG = np.random.default_rng(_SEED)
_TABLE = _RNG.integers(0, 2**64, 256, np.uint64)
_BASE = int(_RNG.integers(0, 2**64, dtype=np.uint64)) | 1
#: Places within a run of the anchor search; longer texts are searched in overlapping runs.
_PLACE_BITS = 24
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as have been asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            run = lambda base: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]))
            self.up, self.down = run(np.uint64(_BASE)), run(np.uint64(pow(_BASE, -1, 2**64)))


_POWERS = Powers()


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, from minima before and after the ends of blocks of that width."""
    n = len(keys)
    whole = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    whole[:n] = keys
    blocks = whole.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchored_runs(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Start, number, anchor hash and content hash of the runs of `length`-byte strings that share an anchor.

    The anchor of a string is the leftmost of its `anchor`-byte parts with the smallest hash, so equal strings have
    equal anchors wherever they stand, and each place of the text begins a string of exactly one run. A run's content
    are the bytes of all its strings.
    """
    limit = (1 << _PLACE_BITS) - 1
    if len(data) > limit:
        step, parts = limit - length + 1, []
        for at in range(0, len(data) - length + 1, step):
            starts, *rest = anchored_runs(data[at : at + limit], length, anchor)
            parts.append((starts + at, *rest))
        return tuple(np.concatenate(p) for p in zip(*parts))
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    _POWERS.grow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * _POWERS.up[:n], out=sums[1:])
    grams = _mixed((sums[anchor:] - sums[:-anchor]) * _POWERS.down[: n - anchor + 1])
    keys = (grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
    places = (_sliding_min(keys, length - anchor + 1) & _PLACES).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    ends = np.concatenate([starts[1:], [len(places)]])
    content = (sums[ends - 1 + length] - sums[starts]) * _POWERS.down[starts] + ends.astype(np.uint64) - starts.astype(np.uint64)
    return starts, ends - starts, grams[places[starts]], _mixed(content)


def _suffix_order(text: np.ndarray, content: np.ndarray, ends: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes in order, each compared up to the end of its content; contents that end alike go by number.

    Ranks of the first symbols double in length each round; only suffixes whose rank is still shared are sorted again.
    Suffixes that agree in `depth` symbols may come in any order, which the intervals of strings up to that length do
    not show.
    """
    n, contents = len(text), len(ends)
    at_end = ends[content]
    width = 7
    packed = np.zeros(n, np.int64)
    place = np.arange(n)
    for k in range(width):
        packed[: n - k] |= text[k:] << 9 * (width - 1 - k)
    packed &= ~((1 << 9 * (width - np.arange(width + 1))) - 1)[np.minimum(at_end - place, width)]
    order = np.argsort(packed)  # what is equal is told apart below
    fresh = np.concatenate([[True], np.diff(packed[order]) != 0])
    begins = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    rank = np.empty(n, np.int64)
    rank[order] = begins
    slots = np.arange(n)
    while depth is None or width < depth:
        shared = np.zeros(len(order), bool)
        same = begins[1:] == begins[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        order_open, slots = order[shared], slots[shared]
        if not len(order_open):
            order = order_open
            break
        beyond = order_open + width
        inside = beyond <= at_end[order_open]
        second = np.where(inside, rank[np.minimum(beyond, n - 1)] + contents, content[order_open])
        first = begins[shared]
        key = first * (n + contents) + second
        by = np.argsort(key, kind="stable")
        order, key = order_open[by], key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        begins = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        rank[order] = begins
        width *= 2
    result = np.empty(n, np.int64)
    result[rank] = place
    # Where ranks are still shared, their places are filled one each.
    result[slots] = order
    return result


def boundaries(order: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Where neighbours in suffix order have fewer than `length` symbols in common (with one entry more, for the end).

    Breadth first from the intervals of single symbols: an interval of a string is extended backwards by every symbol
    before it, through the last-to-first mapping of the transform. The right end of an interval of m symbols that no
    shorter string has ended before has m - 1 common symbols, so values come in increasing order, and the search stops
    at the wanted length. Symbol 0 ends a content and is never extended by.
    """
    n = len(order)
    before = np.where(order > 0, text[order - 1], 0)
    to_first = np.empty(n, np.int64)
    to_first[np.argsort(before.astype(np.uint16), kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    counts = np.bincount(text, minlength=257)
    firsts = np.cumsum(counts) - counts
    symbol_begins = np.zeros(n + 1, bool)
    symbol_begins[firsts] = True
    present = np.flatnonzero(counts[1:]) + 1
    ends = counts[0]
    low = np.concatenate([np.arange(ends), firsts[present]])
    high = np.concatenate([np.arange(ends) + 1, firsts[present] + counts[present]])
    for common in range(length):
        fresh = ~known[high]
        known[high] = True
        # The first level goes on with every interval; the interval of the last symbol ends where all end.
        keep = fresh | (high == n) if common == 0 else fresh
        low, high = low[keep], high[keep]
        if not len(low):
            break
        sizes = high - low
        single = low[sizes == 1]
        single = to_first[single[before[single] > 0]]
        low, high, sizes = low[sizes > 1], high[sizes > 1], sizes[sizes > 1]
        total = int(sizes.sum())
        if total:
            owner = np.repeat(np.arange(len(low)), sizes)
            rows = np.arange(total) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
            inner = before[rows] > 0
            rows, owner = to_first[rows[inner]], owner[inner]
            if total * 8 > n:
                owners = np.full(n, -1)
                owners[rows] = owner
                rows = np.flatnonzero(owners >= 0)
                owner = owners[rows]
            else:
                by = np.argsort(rows)
                rows, owner = rows[by], owner[by]
            begin = np.ones(len(rows), bool)
            begin[1:] = (rows[1:] != rows[:-1] + 1) | (owner[1:] != owner[:-1]) | symbol_begins[rows[1:]]
            at = np.flatnonzero(begin)
            low = rows[at]
            high = low + np.diff(np.concatenate([at, [len(rows)]]))
        low, high = np.concatenate([low, single]), np.concatenate([high, single + 1])
    return known


def repeated_strings(contents: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each content, the ranges of places whose next `length` bytes occur at least twice.

    Contents differ from each other; `counts` says how often each of them occurs.
    """
    sizes = np.array([len(c) for c in contents])
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, np.int64)
    content = np.repeat(np.arange(len(contents)), sizes + 1)
    inner = np.ones(len(text), bool)
    inner[ends] = False
    text[inner] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64) + 1
    order = _suffix_order(text, content, ends, length)
    group = np.cumsum(boundaries(order, text, length)[:-1]) - 1
    often = np.bincount(group, counts[content[order]])[group] > 1
    long_enough = order + length <= ends[content[order]]
    marked = np.zeros(len(text) + 1, bool)
    marked[order[often & long_enough]] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked])))
    out: list[list[tuple[int, int]]] = [[] for _ in contents]
    for a, b in zip(edges[::2], edges[1::2]):
        c = content[a]
        begin = int(ends[c]) - len(contents[c])
        out[c].append((int(a) - begin, int(b) - begin))
    return out


def _merged(ranges: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that touch or overlap as one."""
    out: list[list[int]] = []
    for a, b in ranges[np.argsort(ranges[:, 0], kind="stable")].tolist():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _pairs(value) -> np.ndarray:
    """An array of (a, b) structs, or null, as a matrix."""
    return np.array([(r["a"], r["b"]) for r in value] if value is not None else [], np.int64).reshape(-1, 2)


RANGES = "array<struct<a:long,b:long>>"


def repeated_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    block_bytes: int = BLOCK_BYTES,
    max_anchor_bytes: int = MAX_ANCHOR_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, text, spans; spans are the maximal byte ranges (a, b) covered by repeated strings.

    A string is `length` bytes of a text's UTF-8 (null: empty) and is repeated if it starts anywhere else, in the same
    or another text. Shorter texts have no spans. Rows that repeat are texts of their own. The input has to give the
    same rows in the same places when it is read again, as files do.

    Strings are dealt out by anchors, which equal strings share, so that a block of anchors has all occurrences of its
    strings. Anchors that occur once are dropped after a count; equal runs of strings become one content with a count
    before any bytes are moved; so groups of copies arrive as one line. All strings of a content that occurs more than
    once are repeated; an anchor that has no other contents has nothing left to compare, so its bytes are not moved. Each
    block of the other anchors' distinct contents is settled by a Burrows-Wheeler transform. An anchor whose contents exceed `max_anchor_bytes` is settled by counting its strings
    one by one, which needs no group in one place.
    """
    texts = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for place, text in zip(batch["place"], batch["text"]):
                starts, sizes, anchors, hashes = anchored_runs(np.frombuffer(text.encode(), np.uint8), length, anchor)
                if len(starts):
                    parts.append((np.full(len(starts), place), starts, sizes, anchors.view(np.int64), hashes.view(np.int64)))
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
            yield pd.DataFrame(dict(zip(("place", "start", "strings", "anchor", "content"), columns)))

    found = texts.select("place", "text").mapInPandas(runs, "place long, start long, strings long, anchor long, content long")
    shared = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    runs_of_shared = staged(found.join(shared, "anchor"), "runs")
    counted = staged(
        runs_of_shared.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("place", "start", "strings")).alias("at")),
        "counted",
    )
    # Staged, so that the joins with it can be split.
    open_ = staged(counted.groupBy("anchor").agg(F.min("n").alias("least")).filter("least = 1").select("anchor"), "open")
    contents = counted.join(open_, "anchor", "left_semi")
    everywhere = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("at.strings").alias("b")))
    whole = counted.join(open_, "anchor", "left_anti").select("anchor", "content", everywhere.alias("ranges"))

    def cut(rows: pd.Series, at: pd.Series) -> pd.Series:
        out = []
        for text, runs in zip(rows, at):
            data = text.encode()
            out.append([data[r["start"] : r["start"] + r["strings"] + length - 1] for r in runs])
        return pd.Series(out, dtype=object)

    by_text = contents.groupBy(F.col("at.place").alias("place")).agg(
        F.collect_list(F.struct("anchor", "content", "n", "at.start", "at.strings")).alias("runs")
    )
    pieces = (
        texts.select("place", "text")
        .join(by_text, "place")
        .select(F.explode(F.arrays_zip("runs", F.pandas_udf(cut, "array<binary>")("text", "runs").alias("bytes"))).alias("p"))
        .select("p.runs.anchor", "p.runs.content", "p.runs.n", "p.bytes")
    )
    pieces = staged(pieces, "contents")
    heavy = pieces.groupBy("anchor").agg(F.sum(F.length("bytes")).alias("size")).filter(F.col("size") > max_anchor_bytes).select("anchor")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from batch[["anchor", "content", "n", "bytes"]].itertuples(index=False, name=None)

        held: list[tuple] = []
        size = 0
        for _, group in groupby(lines(), key=lambda r: r[0]):
            rows = list(group)
            more = sum(len(r[3]) for r in rows)
            if held and size + more > block_bytes:
                yield settled(held)
                held, size = [], 0
            held += rows
            size += more
        if held:
            yield settled(held)

    def settled(rows: list[tuple]) -> pd.DataFrame:
        ranges = repeated_strings([r[3] for r in rows], np.array([r[2] for r in rows]), length)
        some = [(r[0], r[1], [{"a": a, "b": b} for a, b in found]) for r, found in zip(rows, ranges) if found]
        return pd.DataFrame(some, columns=["anchor", "content", "ranges"])

    result = f"anchor long, content long, ranges {RANGES}"
    light = pieces.join(heavy, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    by_block = light.mapInPandas(settle, result)

    def digests(values: pd.Series) -> pd.Series:
        each = lambda data: [hashlib.blake2b(data[i : i + length], digest_size=16).digest() for i in range(len(data) - length + 1)]
        return pd.Series([each(v) for v in values], dtype=object)

    strings = (
        pieces.join(heavy, "anchor", "left_semi")
        .select("anchor", "content", "n", F.posexplode(F.pandas_udf(digests, "array<binary>")("bytes")).alias("a", "string"))
    )
    common = strings.groupBy("string").agg(F.sum("n").alias("times")).filter("times > 1").select("string")
    one_by_one = (
        strings.join(common, "string")
        .groupBy("anchor", "content")
        .agg(F.collect_list(F.struct(F.col("a").cast("long").alias("a"), (F.col("a") + 1).cast("long").alias("b"))).alias("ranges"))
    )

    ranges = staged(by_block.unionByName(one_by_one).unionByName(whole), "ranges")
    spans = (
        runs_of_shared.join(ranges, ["anchor", "content"])
        .select("place", F.explode("ranges").alias("r"), "start")
        .groupBy("place")
        .agg(F.collect_list(F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + length - 1).alias("b"))).alias("found"))
    )
    merge = F.pandas_udf(lambda c: pd.Series([[{"a": a, "b": b} for a, b in _merged(_pairs(v))] for v in c], dtype=object), RANGES)
    return texts.join(spans, "place", "left").select("doc_id", "text", merge("found").alias("spans"))


def span_digests(spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is left, from texts and their spans."""

    def digest(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(texts, spans):
            data, at, kept = text.encode(), 0, hashlib.sha256()
            pairs = _pairs(found).tolist()
            for a, b in pairs:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            rows.append((len(data), sum(b - a for a, b in pairs), len(pairs), kept.hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    made = F.pandas_udf(digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")("text", "spans")
    return spans.select("doc_id", made.alias("d")).select("doc_id", "d.*")


def without_spans(spans: DataFrame) -> DataFrame:
    """doc_id and the text without its spans; a character of which a byte is taken away goes whole or in part with it."""

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans):
            data, at, parts = text.encode(), 0, []
            for a, b in _pairs(found).tolist():
                parts.append(data[at:a])
                at = b
            out.append(b"".join([*parts, data[at:]]).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    return spans.select("doc_id", F.pandas_udf(cut, "string")("text", "spans").alias("text"))
