"""Periodic runs of words: seeds on diagonals, extended once for each lag."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LENGTH = 24
MIN_PERIODS = 3
#: Documents are taken together up to so many words; a longer one is taken by itself.
WORDS_AT_ONCE = 200_000
#: Bits of the table that tells which grams can have a partner; a false hit only costs a comparison.
_FILTER_BITS = 20

RUNS = "array<struct<start:long,length:long,period:long>>"

_RNG = np.random.default_rng(11)
_BASE = np.uint64(int(_RNG.integers(0, 2**63)) * 2 + 1)


class Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag + 1, k) for all periods that a text of `longest` words can repeat `MIN_PERIODS` times.

    A run with period q has two equal stretches q apart of at least max(MIN_LENGTH - q, (MIN_PERIODS - 1) * q) words. Of
    all lags of a scale that is 2 * k words or more, so each such stretch holds a whole k-gram that begins at a multiple
    of k.
    """
    low, high = 1, 16
    while MIN_PERIODS * low <= longest:
        # The bound falls until q is a third of MIN_LENGTH and rises from there on.
        overlap = min(max(MIN_LENGTH - q, (MIN_PERIODS - 1) * q) for q in range(low, min(high, low + MIN_LENGTH)))
        yield low, high, overlap // 2
        low, high = high, 2 * high


class _Grams:
    """Hashes of the grams of any length, from sums over prefixes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        self.up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed * self.up[:n], out=self.sums[1:])

    def of(self, k: int) -> np.ndarray:
        """Equal grams have equal hashes; the powers are brought to the same exponent."""
        n = len(self.sums) - 1
        h = (self.sums[k:] - self.sums[: n - k + 1]) * self.up[n - k :: -1]
        return h ^ (h >> np.uint64(31))


def _seeds(grams: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal k-grams: first places (multiples of k) and lags from `low` below `high`.

    A first place has fewer than `high - low` partners, so there are at most (high - low) / k pairs for each word.
    """
    blocks = np.arange(0, len(grams), k)
    of_block = grams[blocks]
    mask = np.uint64((1 << _FILTER_BITS) - 1)
    wanted = np.zeros(1 << _FILTER_BITS, bool)
    wanted[of_block & mask] = True
    places = np.flatnonzero(wanted[grams & mask])
    _, name = np.unique(grams[places], return_inverse=True)
    width = len(grams) + 2 * high
    key = np.sort(name.astype(np.int64) * width + places)
    own = name[np.searchsorted(places, blocks)].astype(np.int64) * width + blocks
    begin, end = np.searchsorted(key, own + low), np.searchsorted(key, own + high)
    counts = end - begin
    first = np.repeat(blocks, counts)
    at = np.arange(int(counts.sum())) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
    return first, key[at] % width - first


def _equal_length(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries agree."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 4
    return n


def find_runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in an array of numbers, by start and period.

    A run is a longest stretch with smallest period q of at least MIN_LENGTH entries and MIN_PERIODS periods. Numbers that
    occur once divide the array into texts of at most `longest` entries.

    Scale by scale, equal k-grams of the guaranteed overlap seed the diagonal of their lag. A table by lag holds how far
    the diagonal has been covered, so a stretch is extended once however many seeds lie on it. Lags go up, so a stretch
    whose smallest period is shorter has been found already: it has the same start and end, and seeds inside it at a
    multiple of its period are left out before they are extended.
    """
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    hashes = _Grams(words)
    backwards = words[::-1]
    for low, high, k in scales(longest):
        if k + low > n:
            break
        first, lag = _seeds(hashes.of(k), k, low, high)
        if not len(first):
            continue
        # A stretch of low + k words has at most one smallest period below `low`, so one known run at most owns a block.
        owned, reach = np.zeros(n // k + 1, np.int64), np.zeros(n // k + 1, np.int64)
        for (start, end), period in found.items():
            if end - start >= low + k:
                blocks = slice(-(-start // k), max((end - low - k) // k + 1, 0))
                owned[blocks], reach[blocks] = period, end
        block = first // k
        known = (owned[block] > 0) & (lag % np.maximum(owned[block], 1) == 0) & (first + lag < reach[block])
        first, lag = first[~known], lag[~known]
        order = np.lexsort((first, lag))
        covered: dict[int, int] = {}
        for i, q in zip(first[order].tolist(), lag[order].tolist()):
            if i < covered.get(q, 0):
                continue
            right = i + _equal_length(words[i:], words[i + q :])
            if right - i < k:  # equal hashes of different grams
                continue
            left = i - _equal_length(backwards[n - i :], backwards[n - i - q :])
            covered[q] = right
            span = (left, right + q)
            if right + q - left >= max(MIN_LENGTH, MIN_PERIODS * q) and span not in found:
                found[span] = q
    return sorted((start, end - start, period) for (start, end), period in found.items())


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()])


def _together(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; texts stand in one array with a number of its own after each."""
    numbers = Numbers()
    ids = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]
    parts = []
    for k, one in enumerate(ids):
        parts += [one, np.array([len(numbers) + k])]
    sizes = np.array([len(one) + 1 for one in ids])
    begins = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(np.concatenate(parts), int(sizes.max()) - 1):
        text = int(np.searchsorted(begins, start, "right")) - 1
        out[text].append((start - int(begins[text]), length, period))
    return out


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by start, then period) and collapsed.

    Words are stretches of a text without the six white spaces of ASCII; a null or empty text has none and collapses to
    the empty string. A run is a longest stretch of words with a smallest period q, of at least 24 words and 3 periods.
    Collapsed are the words that no run holds after its first period, joined by one space. Rows that repeat are each
    given again, null ids stay null, and other columns of the table, whatever their names, are not read. An empty table
    gives an empty one. A task holds about `WORDS_AT_ONCE` words at a time, or one longer text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            first, held, size = 0, [], 0
            for i in range(len(batch)):
                words = (texts[i].as_py() or b"").split()
                if held and size + len(words) > WORDS_AT_ONCE:
                    yield _rows(batch.slice(first, len(held)), held)
                    first, held, size = i, [], 0
                held.append(words)
                size += len(words)
            if held:
                yield _rows(batch.slice(first, len(held)), held)

    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string").fields])
    return texts.mapInArrow(scan, kind)


_RUN_TYPE = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def _rows(batch: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
    found = _together(texts)
    runs = [[{"start": s, "length": n, "period": q} for s, n, q in one] for one in found]
    collapsed = pa.array([_kept(words, one) for words, one in zip(texts, found)], pa.binary()).cast(pa.string())
    arrays = [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(runs, pa.list_(_RUN_TYPE)), collapsed]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])


def longest_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first by start, then period. Null if there is none."""
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(more(best, r), r).otherwise(best))


def with_planted_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with periods planted into the texts of some documents, as a test of the operator on whole tables.

    With h the CRC-32 of the decimal id and g = h // 10, a text of n > 0 words whose h % 10 is 0 has each word i from
    a = g % n on replaced by its word a + (i - a) % p, where p = 1 + (n - a) // (3 + g % 8). A null id plants nothing.
    """
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " ")

    text = F.col(f"`{text_col}`")
    # The words are the one entry of an array, so that they are split once and not for every place.
    words = F.array(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    changed = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, planted(w))), F.lit(0))
    return df.withColumn(text_col, F.when(F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False)), changed).otherwise(text))
