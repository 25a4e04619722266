import re
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tianguis.llm import periodic_runs as module
from tianguis.llm import queries
from tianguis.llm.periodic_runs import find_runs, periodic_runs, scales, with_planted_runs


def plain_runs(words):
    """Every run, by comparing the whole text with itself at every lag."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids, found = np.array([numbers[w] for w in words], np.int64), {}
    for q in range(1, len(ids) // 3 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids[:-q] == ids[q:], [False]])))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted_words(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = planted_words(doc_id, words_of(text))
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    digest = lambda t: sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in drop)), len(words),
    )


blocks = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 6)), min_size=1, max_size=6)


@settings(deadline=None, max_examples=400)
@given(blocks)
def test_runs_equal_a_trial_of_every_period(parts):
    words = [w for block, times in parts for w in block * times]
    assert find_runs(np.array(words, np.int64), len(words)) == plain_runs(words)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 1), max_size=150), max_size=8))
def test_texts_that_stand_together_do_not_meet(texts):
    texts = [[b"%d" % w for w in t] for t in texts] or [[]]
    assert module._together(texts) == [plain_runs(t) for t in texts]


def test_each_stretch_of_a_scale_holds_a_whole_gram():
    for low, high, k in scales(5000):
        for q in {low, min(low + 7, high - 1), high - 1}:
            assert max(24, 3 * q) - q >= 2 * k - 1


@pytest.mark.parametrize("words", [[1] * 30_000, [1] * 4_000 + [2] + [1] * 4_000, ([1] * 700 + [2]) * 30, list(range(3000)) * 4])
def test_long_repetitive_texts(words):
    """Constant texts and nested periods; work must not grow with the square of the length."""
    assert find_runs(np.array(words, np.int64), len(words)) == plain_runs(words)


def test_query_agrees_with_the_definition_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    result = queries.op11_periodic_runs(spark, "/root/testdata/sf0.001")
    assert result.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, result.collect())) == sorted(expected(*r) for r in docs)


def test_edges(spark, documents):
    loop = " ".join(["a", "b", "c"] * 9)
    rows = [
        (1, None), (2, ""), (3, " \n\t\x0b\x0c\r"), (4, loop), (4, loop), (None, loop), (5, "x " * 23), (6, "x " * 24),
        (7, "ñ ñ " * 30), (8, " ".join(map(str, range(50_000)))),
    ]
    df = documents(rows).withColumns({"runs": F.lit(1), "collapsed": F.lit("other"), "n_words": F.lit(None).cast("int"), "words`": F.lit(2)})
    got = sorted(map(tuple, periodic_runs(df).collect()), key=repr)
    assert sorted([(g[0], g[1], [tuple(r) for r in g[2]]) for g in got], key=repr) == sorted(
        [
            (1, 0, []), (2, 0, []), (3, 0, []), (4, 27, [(0, 27, 3)]), (4, 27, [(0, 27, 3)]), (None, 27, [(0, 27, 3)]),
            (5, 23, []), (6, 24, [(0, 24, 1)]), (7, 30, [(0, 30, 1)]), (8, 50_000, []),
        ],
        key=repr,
    )
    text = {(g[0]): g[3] for g in got}
    assert text[1] == text[2] == text[3] == "" and text[4] == "a b c" and text[5] == "x " * 22 + "x" and text[7] == "ñ ñ"
    assert periodic_runs(df.filter("doc_id > 100")).collect() == []


def test_planting_keeps_other_rows_and_columns(spark, documents):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 90))) for i in range(300)] + [(None, "a b")]
    df = documents(rows).withColumn("w", F.lit(7))
    got = with_planted_runs(df)
    assert got.columns == df.columns
    for r in got.collect():
        before = words_of(dict(rows)[r.doc_id])
        assert words_of(r.text) == (before if r.doc_id is None else planted_words(r.doc_id, before))
