"""Similarity join on word shingles: a MinHash LSH forest for candidates, exact verification in blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.components import connected_components
from tianguis.llm.staging import staged
from tianguis.llm.tokens import Words

WORDS = 5
THRESHOLD = 0.8
TREES = 40
MAX_DEPTH = 16
#: The first level of the forest looks at prefixes that are this much longer than the last.
LONGER = 2
#: The share of the pairs exactly at the threshold that the forest has to find; more similar pairs are found more surely.
TARGET_RECALL = 0.99999
SEED = 4
#: Bits kept of a minhash (the comparison counts symbols of two) to tell pairs that are far from similar, and how many standard deviations a pair at the threshold
#: may fall short of what it should agree in.
SKETCH_BITS = 2
SLACK = 6
#: A verification task holds two groups of members of about so many shingles and documents each.
BLOCK_SHINGLES = 2_000_000
BLOCK_DOCUMENTS = 2_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def forest_depth(threshold: float, trees: int, target: float, longest: int = MAX_DEPTH) -> int:
    """The longest prefix at which the forest still finds `target` of the pairs at the threshold.

    A pair of similarity s shares a prefix of d minhashes in one tree with probability s^d. Prefixes are shortened one
    minhash at a time from the longest, and at the last one whatever the target.
    """
    for depth in range(longest, 1, -1):
        if 1 - (1 - threshold**depth) ** trees >= target:
            return depth
    return 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=1)
def _word_hashes() -> Words[int]:
    return Words(lambda word: xxhash.xxh64_intdigest(word.encode()))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the different word shingles; a text of fewer words is one shingle, an empty one none."""
    tokens = text.split()
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, tokens), np.uint64, len(tokens))
    n = max(len(tokens) - words + 1, 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(words, len(tokens))):
        h = _mixed(h + hashes[k : k + n])
    return np.unique(h)


def forest_levels(threshold: float, trees: int, target: float) -> list[int]:
    """Lengths of the prefixes that are matched, the longest first; the last is `forest_depth`."""
    last = forest_depth(threshold, trees, target)
    return [depth for depth in (last + LONGER, last) if depth <= MAX_DEPTH]


class Forest:
    """The signature of a shingle set: a path of minhashes in each tree, and a few bits of every minhash."""

    def __init__(self, trees: int, levels: list[int]):
        rng = np.random.default_rng(SEED)
        depth = levels[0]
        self.trees, self.depth, self.levels = trees, depth, levels
        self.factors = rng.integers(0, 2**64, trees * depth, np.uint64) | np.uint64(1)
        self.shifts = rng.integers(0, 2**64, trees * depth, np.uint64)
        self.labels = rng.integers(0, 2**64, trees, np.uint64)

    def signature(self, shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Hashes of the path of each tree, level after level, and the sketch."""
        least = np.full(self.trees * self.depth, np.uint64(2**64 - 1))
        for at in range(0, len(shingles), 512):
            part = shingles[None, at : at + 512] * self.factors[:, None] + self.shifts[:, None]
            np.minimum(least, part.min(axis=1), out=least)
        path, paths = self.labels, {}
        for depth, minhashes in enumerate(least.reshape(self.trees, self.depth).T, 1):
            path = _mixed(path + minhashes)
            paths[depth] = path.view(np.int64)
        symbols = (_mixed(least) >> np.uint64(64 - SKETCH_BITS)).astype(np.uint8)
        bits = np.unpackbits(symbols[:, None], axis=1)[:, -SKETCH_BITS:]
        return np.concatenate([paths[d] for d in self.levels]), np.packbits(bits).tobytes()


def most_disagreements(minhashes: int, threshold: float, slack: float = SLACK) -> int:
    """How many symbols of the sketches of two sets at the threshold may differ, but for `slack` standard deviations."""
    differs = (1 - threshold) * (1 - 0.5**SKETCH_BITS)
    return int(minhashes * differs + slack * (minhashes * differs * (1 - differs)) ** 0.5)


def _sketch_edges(rows: list[tuple], across: bool, most: int) -> list[tuple]:
    """(member, other) of members of a bucket whose sketches agree, as few as join the labels that such pairs join.

    `rows` are (member, own group, label, sketch). Members that are joined already are not compared any further.
    """
    members, sides = [r[0] for r in rows], np.array([r[1] for r in rows])
    width = len(rows[0][3])
    sketches = np.frombuffer(b"".join(r[3] + bytes(-width % 8) for r in rows), np.uint64).reshape(len(rows), -1)
    sketches = np.ascontiguousarray(sketches.T)
    labels, out = np.unique([r[2] for r in rows], return_inverse=True)[1], []
    low = np.uint64(0x5555555555555555)  # the lower bit of every two-bit symbol
    for i in range(len(rows)):
        others = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
        if across:
            others = others[sides[others] != sides[i]]
        if not len(others):
            if (labels == labels[0]).all():
                break
            continue
        differ = np.zeros(len(others), np.int64)
        for words in sketches:
            z = words[others] ^ words[i]
            differ += np.bitwise_count((z | (z >> np.uint64(1))) & low)
        found = others[differ <= most]
        _, one_each = np.unique(labels[found], return_index=True)
        for j in found[one_each]:
            out.append((members[i], members[j]))
            labels[labels == labels[j]] = labels[i]
    return out


def _pairs_within(sets: list[np.ndarray], sides: np.ndarray, across: bool, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each member, the members after it that are similar enough; `across`: only of the other side."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, shared, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(shared, kind="stable")
    ends = np.cumsum(counts)
    posted, sizes = owner[order], np.array([len(s) for s in sets])
    ids = np.split(shared, np.cumsum(sizes)[:-1])
    for i, mine in enumerate(ids):
        mine = mine[counts[mine] > 1]
        if not len(mine):
            continue
        common = np.bincount(np.concatenate([posted[ends[k] - counts[k] : ends[k]] for k in mine]), minlength=len(sets))
        similar = common >= threshold * (sizes[i] + sizes - common) - 1e-9
        similar[: i + 1] = False
        if across:
            similar &= sides != sides[i]
        found = np.flatnonzero(similar)
        if len(found):
            yield i, found


def _verified(rows: list[tuple], across: bool, threshold: float) -> list[tuple]:
    """(member, other, links): a count of links for each member, other null, and links that span the linked members."""
    members = [r[0] for r in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    sets, sides = [np.frombuffer(r[2], np.uint64) for r in rows], np.array([r[1] for r in rows])
    for i, others in _pairs_within(sets, sides, across, threshold):
        links[i] += len(others)
        for j in others:
            links[j] += 1
            if (a := root(i)) != (b := root(int(j))):
                parent[a] = b
                out.append((members[i], members[j], 0))
    return out + [(m, None, n) for m, n in zip(members, links) if n]


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    target_recall: float = TARGET_RECALL,
    block_shingles: int = BLOCK_SHINGLES,
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """One row per input row: doc_id, copy_id, class_id, n_links, kept (and `row`, the input row, if asked).

    Two texts are linked if the Jaccard similarity of their sets of word shingles is at least `threshold`. Rows with
    equal sets are copies of one member, with the smallest of their ids as copy_id; n_links counts the other members
    that a row's member is linked with; class_id is the smallest id of all members that are linked directly or through
    others; of a class the row with that id is kept, and of rows that repeat it the first. Null ids are smaller than
    any other, so a class with one has class_id null. Null text counts as empty; texts without words are copies of each
    other and linked with none. Words are what white space parts, in the case they have.

    Candidates come from the forest, the longest prefixes first. Members that share a prefix in some tree are a bucket;
    those whose sketches agree nearly as much as two sets at the threshold would are joined. Prefixes are then shortened,
    up to the length that meets the target recall, and only buckets go on whose members are not all joined yet. Members
    that share a longer prefix share the shortest too, so all paths are compared once, by the shortest, and every length
    looks only at what met there. What is joined is verified exactly. A bucket of texts that are far from similar (half a page of one template) so joins
    nothing. Members meet in blocks of a bounded size, in buckets and in verification: a group over it is cut into
    parts, each two of which meet once, so no task holds a group and no pair leaves a task but as a count or as one of
    the few edges that join it. Equal sets meet once whatever their number.
    """
    levels = forest_levels(threshold, trees, target_recall)
    most = most_disagreements(trees * levels[0], threshold)

    def sketched(texts: pd.Series) -> pd.DataFrame:
        forest, rows = Forest(trees, levels), []
        for text in texts:
            shingles = shingle_set(text, words)
            paths, sketch = forest.signature(shingles) if len(shingles) else (None, None)
            rows.append((hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), paths, sketch))
        return pd.DataFrame(rows, columns=["digest", "paths", "sketch"])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if carry else F.struct(text.alias(text_col))
    rows = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.pandas_udf(sketched, "digest binary, paths array<long>, sketch binary")(text).alias("s"),
        whole.alias("row"),
    )
    rows = staged(rows.select("doc_id", "place", "s.*", "row"), "shingles")
    # Staged, as are all counts and minima below: a join splits a hot key only if neither side was grouped by it.
    digests = staged(rows.groupBy("digest").agg(F.min("place").alias("member")), "digests")
    members = staged(rows.select("doc_id", "place", "digest").join(digests, "digest").drop("digest"), "members")
    met = staged(_met(rows, members, len(levels), trees), "met")
    sketches = rows.filter("sketch IS NOT NULL").select(F.col("place").alias("member"), "sketch")
    edges, components = None, None
    for at in range(len(levels)):
        found = staged(_level_edges(met, f"p{at}", sketches, components, most, block_documents), "edges")
        edges = found if edges is None else edges.unionByName(found)
        components = staged(connected_components(edges), "candidates")

    def shingles_of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, words).tobytes() for t in texts], dtype=object)

    sets = (
        rows.select(F.col("place").alias("node"), F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"))
        .join(components, "node")
        .select("component", "node", F.pandas_udf(shingles_of, "binary")("text").alias("shingles"))
    )
    sets = staged(sets, "sets")
    sizes = sets.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.length("shingles") / 8).alias("total"))
    groups = F.ceil(F.greatest(F.col("n") / block_documents, F.col("total") / block_shingles)).cast("int")
    sizes = staged(sizes.select("component", groups.alias("groups")), "sizes")
    dealt = _dealt(sets.join(sizes, "component"), "component", "node", "shingles")

    def verify(part: list[tuple], across: bool) -> list[tuple]:
        return _verified(part, across, threshold)

    links = staged(_by_block(dealt, verify, "a long, b long, links long"), "links")
    linked = connected_components(links.filter("b IS NOT NULL").select("a", "b"))
    degrees = links.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    known = degrees.join(linked, "node", "full").select(F.col("node").alias("member"), "n_links", "component")
    known = staged(known, "known")

    per_row = staged(
        members.join(known, "member", "left").select(
            "doc_id",
            "place",
            "member",
            F.coalesce("component", "member").alias("component"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ),
        "classes",
    )
    copies = staged(per_row.groupBy("member").agg(F.min(F.struct("doc_id", "place")).alias("copy")), "copies")
    classes = staged(per_row.groupBy("component").agg(F.min(F.struct("doc_id", "place")).alias("head")), "heads")
    result = (
        per_row.join(copies, "member")
        .join(classes, "component")
        .select(
            "doc_id",
            F.col("copy.doc_id").alias("copy_id"),
            F.col("head.doc_id").alias("class_id"),
            "n_links",
            (F.col("place") == F.col("head.place")).alias("kept"),
            "place",
        )
    )
    return result.join(rows.select("place", "row"), "place").drop("place") if carry else result.drop("place")


def _met(rows: DataFrame, members: DataFrame, levels: int, trees: int) -> DataFrame:
    """(member, p0, p1, ..) of the members that share their shortest path in a tree with another one; p0 is the longest.

    Paths of rows that are copies of one member are told by a label that is the same for equal sets, so that what is
    moved are paths and places alone; two sets of one label are missed with a probability of 2^-32, if no third is there.
    """
    path = lambda at: F.slice("paths", at * trees + 1, trees)
    last = f"p{levels - 1}"
    labelled = rows.select(F.explode(path(levels - 1)).alias(last), F.hash("digest").alias("label"))
    buckets = labelled.groupBy(last).agg(F.min("label").alias("least"), F.max("label").alias("most"))
    open_ = staged(buckets.filter("least != most").select(last), "open")
    names = [f"p{at}" for at in range(levels)]
    paths = rows.select("place", F.inline(F.arrays_zip(*map(path, range(levels)))).alias(*names))
    # Longer paths are looked at within a bucket only, which half of their bits tell apart.
    longer = [F.shiftright(p, 32).cast("int").alias(p) for p in names[:-1]]
    # Paths and open buckets both grow with the rows, so they are merged whatever the size of the table.
    paths = paths.select("place", *longer, last).join(open_.hint("merge"), last)
    met = paths.join(members.select("place", "member"), "place").select("member", *names).distinct()
    return met.select("member", *[F.xxhash64(p, last).alias(p) for p in names[:-1]], last)


def _level_edges(met: DataFrame, path: str, sketches: DataFrame, components: DataFrame | None, most: int, block: int) -> DataFrame:
    """Edges (a, b) that the buckets of one level add; members that `components` lists are joined already."""
    label = F.col("member")
    if components is not None:
        met = met.join(components.withColumnRenamed("node", "member"), "member", "left")
        label = F.coalesce("component", "member")
    paths = met.select(F.col(path).alias("path"), "member", label.alias("label"))
    buckets = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most"))
    groups = F.ceil(F.col("n") / block).cast("int").alias("groups")
    open_ = staged(buckets.filter("least != most").select("path", groups), "buckets")
    met = paths.join(open_, "path").join(sketches, "member")
    return _by_block(
        _dealt(met, "path", "member", "label", "sketch"),
        lambda part, across: _sketch_edges(part, across, most),
        "a long, b long",
    )


def _dealt(df: DataFrame, key: str, node: str, *columns: str) -> DataFrame:
    """Rows of each key in blocks (low, high): the nodes are dealt to as many parts as `groups` says, and two parts meet once."""
    return (
        df.withColumn("own", F.pmod(F.xxhash64(node), F.col("groups")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        .select(F.col(key).alias("key"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), node, "own", *columns)
    )


def _by_block(dealt: DataFrame, work: Callable[[list[tuple], bool], list[tuple]], schema: str) -> DataFrame:
    """`work` on the rows of every block, told whether two different parts meet in it."""
    block = ["key", "low", "high"]
    names = [c.split()[0] for c in schema.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype("Int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines = (line for batch in batches for line in batch.itertuples(index=False, name=None))
        held: list[tuple] = []
        for key, group in groupby(lines, key=lambda r: r[:3]):
            part = [r[3:] for r in group]
            if len(part) > 1:
                held += work(part, key[1] != key[2])
            if len(held) > 20_000:
                yield frame(held)
                held = []
        yield frame(held)

    return dealt.repartition(*block).sortWithinPartitions(*block).mapInPandas(run, schema)
