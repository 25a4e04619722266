"""Packing of token sequences by best-two-fit, planned on the histogram of lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tianguis.llm.staging import Scratch
from tianguis.llm.tokens import TextEncoder, byte_characters, load

CAPACITY = 2048
SEPARATOR = 0
#: Texts are tokenised so many at a time, and pieces leave a task in batches of about so many bytes of ids.
TEXTS_AT_ONCE = 256
BATCH_BYTES = 8 << 20
PIECE = "piece int, start long, length long"
#: Where a row lies: its task, and its number among the rows of its length there.
LIES = "_task long, _number long"
#: Counts by task and length are broadcast up to so many, 24 bytes each; beyond, rows meet them by a shuffle.
MAX_BROADCAST_COUNTS = 1_000_000


def _kind(ids: int) -> str:
    """The bytes that an id takes in flight: two where the vocabulary allows, else four."""
    return "<u2" if ids <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def _encoder(path: str) -> tuple[TextEncoder[bytes], str]:
    """Ids, and the bytes of one, by the tokenizers library: its model for words of plain text, all of it for any other text."""
    tokenizer = load(path)
    merge = tokenizer.model.tokenize
    kind = _kind(tokenizer.get_vocab_size())
    packed = lambda ids: np.array(ids, kind).tobytes()
    characters = str.maketrans(dict(zip(map(chr, range(256)), byte_characters())))
    known = [packed([i]) for i in range(tokenizer.get_vocab_size())]

    def word(w: str) -> bytes:
        return b"".join([known[t.id] for t in merge(w if w.isascii() else w.encode().decode("latin-1").translate(characters))])

    text = lambda t: [packed(tokenizer.encode(t, add_special_tokens=False).ids)]
    return TextEncoder(path, tokenizer, word, text, lambda i: packed([i])), kind


def token_pieces(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, where it lies (see `pack`) and `ids`, as `_kind` says.

    A document is its ids and one separator id; null text counts as empty and leaves the separator alone. Documents
    longer than `capacity` are cut into pieces of that length, of which the last may be shorter. Texts are taken and
    pieces given on in small batches, so a task holds few of either.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kind = _encoder(tokenizer_path)
        tail, width = np.array([SEPARATOR], kind).tobytes(), np.dtype(kind).itemsize
        size, task, met = width * capacity, TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for first in range(0, len(batch), TEXTS_AT_ONCE):
                few = batch.slice(first, TEXTS_AT_ONCE)
                rows, held = [], 0
                for n, text in enumerate(few.column(1).to_pylist()):
                    ids = b"".join([*encoder.parts(text), tail])
                    for k, at in enumerate(range(0, len(ids), size)):
                        part = ids[at : at + size]
                        length = len(part) // width
                        rows.append((n, k, at // width, length, task, met[length], part))
                        met[length] += 1
                        held += len(part)
                        if held > BATCH_BYTES:
                            yield _pieces(few, rows)
                            rows, held = [], 0
                if rows:
                    yield _pieces(few, rows)

    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL(f"{PIECE}, {LIES}, ids binary").fields])
    return texts.mapInArrow(cut, kind)


def _pieces(texts: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    places, *columns = zip(*rows)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [texts.column(0).take(pa.array(places)), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "_task", "_number", "ids"])


class Pattern(NamedTuple):
    """`times` bins with one document of each length, placed in this order."""

    lengths: list[int]
    times: int


class _Stock:
    """How many documents of each length are left, with the next smaller length in stock."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.lengths = np.flatnonzero(self.left)

    def refresh(self) -> None:
        self.lengths = np.flatnonzero(self.left)

    def best(self, gap: int, used: Counter) -> int:
        """The largest length of at most `gap` of which one is left besides those used; 0 if none."""
        at = int(np.searchsorted(self.lengths, gap, "right")) - 1
        while at >= 0 and self.left[length := int(self.lengths[at])] <= used[length]:
            at -= 1
        return int(self.lengths[at]) if at >= 0 else 0

    def best_two(self, gap: int, used: Counter) -> tuple[int, int]:
        """The two lengths in stock whose sum is largest within `gap`; zeros if there are none."""
        best = (0, 0)
        small, large = 0, int(np.searchsorted(self.lengths, gap, "right")) - 1
        while small <= large:
            a, b = int(self.lengths[small]), int(self.lengths[large])
            if self.left[b] <= used[b]:
                large -= 1
            elif self.left[a] <= used[a] or a + b < sum(best):
                small += 1
            elif a + b > gap or (a == b and self.left[a] < used[a] + 2):
                large -= 1
            else:
                best = (a, b) if a + b > sum(best) else best
                small += 1
        return best


def plan_bins(counts: Mapping[int, int], capacity: int) -> Iterator[Pattern]:
    """Patterns of bins that hold `counts[length]` documents of each length.

    A bin is filled greedily, the longest document that fits first. If a gap remains, its smallest document but the
    first gives way to the two documents left over that fill the wider gap best, when they fill more of it. The same
    choice repeats while stocks last, so equal bins are planned at once: the work depends on the number of different
    lengths, which the capacity bounds, and not on the number of documents.
    """
    stock = _Stock(counts, capacity)
    while len(stock.lengths):
        bin_ = [int(stock.lengths[-1])]
        used, gap = Counter(bin_), capacity - bin_[0]
        while gap and (length := stock.best(gap, used)):
            bin_.append(length)
            used[length] += 1
            gap -= length
        if gap and len(bin_) > 1:
            used[bin_[-1]] -= 1
            a, b = stock.best_two(gap + bin_[-1], used)
            if a + b > bin_[-1]:
                bin_[-1:] = sorted((a, b), reverse=True)
                used.update((a, b))
            else:
                used[bin_[-1]] += 1
        times = min(int(stock.left[length]) // n for length, n in used.items() if n)
        for length, n in used.items():
            stock.left[length] -= n * times
        stock.refresh()
        yield Pattern(bin_, times)


def lying(items: DataFrame) -> DataFrame:
    """`items` with its rows' task and their number among the rows of their length there."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, met = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            numbers = []
            for length in batch.column("length").to_pylist():
                numbers.append(met[length])
                met[length] += 1
            yield batch.append_column("_task", pa.array([task] * len(batch), pa.int64())).append_column("_number", pa.array(numbers, pa.int64()))

    return items.mapInArrow(number, T.StructType([*items.schema.fields, *T.StructType.fromDDL(LIES).fields]))


def pack(items: DataFrame, capacity: int = CAPACITY, max_broadcast: int = MAX_BROADCAST_COUNTS) -> DataFrame:
    """`items` (with a column `length` from 1 to `capacity`) with sequence_id and offset, as few sequences as it can.

    Documents of one length are alike to the plan, so the driver sees only the histogram of lengths, at most one count
    for each, and sends back runs of ranks: "of this length, ranks from r on go to sequences from s on, at offset o".
    A row's rank is its number in the task that wrote it and the counts of the tasks before, so rows are staged where they
    are made and are not moved to be ranked. Columns may be null; rows that repeat are packed as often as they come. The
    columns `_task` and `_number` are taken if `items` has both (see `lying`); of `items`, other columns must not be called
    `_task`, `_number`, `_before`, `sequence_id` or `offset`, which is an error.
    """
    spark = items.sparkSession
    given = {"_task", "_number"}
    columns = [c for c in items.columns if c not in given]
    if taken := {"_before", "sequence_id", "offset"} & set(items.columns) or (given & set(items.columns) if not given <= set(items.columns) else set()):
        raise ValueError(f"columns of these names are made here: {', '.join(sorted(taken))}")
    rows = Scratch(spark, "packing").staged(items if given <= set(items.columns) else lying(items), "pieces")
    counts = rows.groupBy("length", "_task").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    keys, first_sequence, offsets, taken, sequence = [], [], [], Counter(), 0
    for pattern in plan_bins(histogram, capacity):
        at = 0
        for length in pattern.lengths:
            keys.append((length, taken[length]))
            first_sequence.append(sequence)
            offsets.append(at)
            taken[length] += pattern.times
            at += length
        sequence += pattern.times
    order = sorted(range(len(keys)), key=keys.__getitem__)
    run_keys = np.array([keys[i][0] * 2**44 + keys[i][1] for i in order], np.int64)
    runs = spark.sparkContext.broadcast(
        (run_keys, np.array([first_sequence[i] for i in order], np.int64), np.array([offsets[i] for i in order], np.int64))
    )

    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        begins, sequences, at = runs.value
        wanted = lengths.to_numpy(np.int64) * 2**44 + ranks.to_numpy(np.int64)
        run = np.searchsorted(begins, wanted, "right") - 1
        return pd.DataFrame({"sequence_id": sequences[run] + wanted - begins[run], "offset": at[run]})

    before = counts.select(
        "length",
        "_task",
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_task")) - F.col("_n")).alias("_before"),
    )
    if counts.limit(max_broadcast + 1).count() <= max_broadcast:
        before = F.broadcast(before)
    placed = F.pandas_udf(place, "sequence_id long, offset long")("length", F.col("_before") + F.col("_number"))
    return rows.join(before, ["length", "_task"]).withColumn("_place", placed).select(*[F.col(f"`{c}`") for c in columns], "_place.*")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences of all documents, with their ids and pieces; see `token_pieces`, `pack` and `sequences`."""
    kind = _kind(load(tokenizer_path).get_vocab_size())
    return sequences(pack(token_pieces(df, tokenizer_path, id_col, text_col, capacity), capacity), kind)


def sequences(packed: DataFrame, kind: str = "<u4") -> DataFrame:
    """Whole sequences of packed pieces that carry `ids`: sequence_id, length, ids and pieces, by their offset.

    Ids come as `kind` and are little-endian 32-bit numbers in the sequence. A sequence is bounded by the capacity, and so is what a group holds.
    """
    piece = ["offset", "doc_id", "piece", "start", "length"]

    wide = lambda some: some.map(lambda ids: np.frombuffer(ids, kind).astype("<u4").tobytes())
    widened = F.pandas_udf(wide, "binary") if kind != "<u4" else lambda c: c
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct(*piece, "ids"))).alias("parts"))
        .select(
            "sequence_id",
            "length",
            widened(joined).alias("ids"),
            F.transform("parts", lambda p: F.struct(*[p[c].alias(c) for c in piece])).alias("pieces"),
        )
    )


def sequence_pieces(packed: DataFrame) -> DataFrame:
    """A row per piece of whole sequences: doc_id, piece, start, length, sequence_id, offset and its ids, cut out of the sequence's."""
    ids = F.substring("ids", F.col("p.offset").cast("int") * 4 + 1, F.col("p.length").cast("int") * 4)
    return packed.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.piece", "p.start", "p.length", "sequence_id", "p.offset", ids.alias("ids")
    )
