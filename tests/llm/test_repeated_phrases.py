import re
from collections import defaultdict
from hashlib import sha256
from uuid import uuid4

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tianguis.llm import queries
from tianguis.llm import repeated_phrases as module
from tianguis.llm.repeated_phrases import Shard, anchored_windows, passage_digests, repeated_passages, without_passages, word_hashes


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(rows, window=20):
    """(doc_id, n_words, n_removed, digest) by looking up every window."""
    order = lambda i: (i is not None, i or 0)
    first = {}
    for i, text in rows:
        words = words_of(text)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            first[key] = min(first.get(key, (order(i), at)), (order(i), at))
    out = []
    for i, text in rows:
        words = words_of(text)
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (order(i), at):
                gone.update(range(at, at + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df, **options):
    return sorted(map(tuple, passage_digests(repeated_passages(df, **options)).collect()), key=repr)


def some_texts(seed, n=60):
    """Texts of few words with shared passages, copies and passages that repeat inside a text."""
    rng = np.random.default_rng(seed)
    passages = [[f"w{k}" for k in rng.integers(0, 50, rng.integers(15, 70))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.integers(0, 5)):
            p = passages[rng.integers(len(passages))]
            a, b = sorted(rng.integers(0, len(p) + 1, 2))
            words += p[a:b] if rng.random() < 0.5 else p
            words += [f"x{k}" for k in rng.integers(0, 10_000, rng.integers(0, 8))]
        rows.append((int(rng.integers(0, 1000)), " ".join(words)))
    return rows + rows[:3] + [(None, rows[0][1]), (5000, rows[1][1].replace(" ", "\n\t"))]


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_a_lookup_of_every_window(documents, seed):
    rows = some_texts(seed)
    assert got(documents(rows)) == expected(rows)


def test_small_shards_and_anchors_dealt_out_one_by_one(documents):
    rows = some_texts(3)
    df = documents(rows)
    assert got(df, shard_words=50) == expected(rows)
    assert got(df, shard_words=200, max_anchor_words=60) == expected(rows)
    assert got(df, max_anchor_words=0) == expected(rows)


def test_query_agrees_with_a_lookup_of_every_window_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    result = queries.op12_repeated_phrases(spark, "/root/testdata/sf0.001")
    assert result.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, result.collect()), key=repr) == expected(rows)
    assert any(r[2] for r in expected(rows))


def test_edges(documents):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [
        (1, None), (2, ""), (3, " \n\x0b"), (4, " ".join(passage.split()[:19])), (7, passage), (6, passage + " tail"), (9, passage), (9, passage),
        (10, "a " * 500), (11, "ñ b " * 30), (12, " ".join(f"v{i}" for i in range(60_000)) + " " + passage), (13, "x" * 300_000 + " " + passage),
    ]
    df = documents(rows).withColumns({"place": F.lit(1), "spans": F.lit("other"), "anchor": F.lit(None).cast("int"), "found`": F.lit(2)})
    assert got(df) == expected(rows)
    assert got(df.filter("doc_id > 100")) == []
    kept = {r.doc_id: r.text for r in without_passages(repeated_passages(df)).collect()}
    assert kept[6] == passage + " tail" and kept[7] == "" and kept[3] == " \n\x0b" and kept[10] == "a"


def test_a_group_of_copies_is_one_line(documents):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text if i % 3 else f"own{i} " * 5 + text) for i in range(300)]
    assert got(documents(rows)) == expected(rows)


def test_long_texts_are_hashed_in_parts(monkeypatch, documents):
    rows = some_texts(4, 20)
    text = "  ".join(t for _, t in rows if t).encode()
    whole = word_hashes(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(module, "BYTES_AT_ONCE", size)
        assert (word_hashes(text) == whole).all() and len(whole) == len(text.split())
    monkeypatch.setattr(module, "WORDS_AT_ONCE", 30)
    found = list(module._parts([text, b"", b"a b", text], 20))
    windows = [(n, f + k) for numbers, firsts, arrays in found for n, f, a in zip(numbers, firsts, arrays) for k in range(len(a) - 19)]
    assert windows == [(n, k) for n in (0, 3) for k in range(len(whole) - 19)]


def test_an_input_that_changes_is_an_error(spark, documents):
    passage = " ".join(f"w{i}" for i in range(30))
    df = documents([(i, passage) for i in range(20)])
    with pytest.raises(Exception, match="other rows"):
        repeated_passages(df.withColumn("doc_id", F.udf(lambda _: uuid4().int >> 70, "long").asNondeterministic()("doc_id"))).collect()


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(0, 3), min_size=8, max_size=120), st.lists(st.integers(0, 3), min_size=8, max_size=120))
def test_equal_windows_have_equal_anchors(a, b):
    words = word_hashes(" ".join(map(str, a + b)).encode())
    text = np.repeat([0, 1], [len(a), len(b)])
    starts, counts, anchors, contents = anchored_windows(words, text, 8, 3)
    covered = sorted(s + k for s, n in zip(starts, counts) for k in range(n))
    assert covered == [*range(len(a) - 7), *range(len(a), len(a) + len(b) - 7)]
    by_window, by_content = defaultdict(set), defaultdict(set)
    whole = a + b
    for s, n, anchor, content in zip(starts, counts, anchors, contents):
        stretch = [tuple(whole[s + k : s + k + 8]) for k in range(n)]
        assert len(set(stretch)) == n
        by_content[anchor, content].add(tuple(whole[s : s + n + 7]))
        for w in stretch:
            by_window[w].add(anchor)
    assert all(len(v) == 1 for v in [*by_window.values(), *by_content.values()])


def test_shard_locates_phrases_and_first_places():
    one, two = [b"%d" % i for i in range(30)], [b"x", *[b"%d" % i for i in range(5, 30)]]
    shard = Shard([(2, (7, 100), one), (1, (3, 0), two), (1, (9, 0), [b"y"] * 20)])
    (inside, later), (other, after), (none, _) = shard.located()
    assert inside.all() and later.tolist() == [False] * 5 + [True] * 6  # the end stands first in the text with id 3
    assert other.tolist() == [False] + [True] * 6 and not after.any() and not none.any()
    assert shard.sizes.count(20) == 6 and shard.sizes.count(24) == 1  # six common windows, one stretch of five
