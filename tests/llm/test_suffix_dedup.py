import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tianguis.llm import suffix_dedup
from tianguis.llm.queries import op2_suffix_dedup
from tianguis.llm.suffix_dedup import _suffix_order, anchored_runs, boundaries, repeated_spans, repeated_strings, span_digests, without_spans


def brute_force(texts, length):
    seen = Counter(d[i : i + length] for d in texts for i in range(len(d) - length + 1))
    out = []
    for data in texts:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((len(data), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return out


def passages(rng, n, alphabet=b"ab \xc3", longest=60):
    parts = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, longest))) for _ in range(6)]
    return [b"".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(n)]


@pytest.mark.parametrize("length", [1, 2, 5, 12])
def test_order_and_boundaries(length):
    rng = random.Random(length)
    for _ in range(60):
        contents = sorted(set(passages(rng, 8, b"ab", 8)))
        sizes = np.array([len(c) for c in contents])
        ends = np.cumsum(sizes + 1) - 1
        text = np.array([x for c in contents for x in [*(b + 1 for b in c), 0]])
        content = np.repeat(np.arange(len(contents)), sizes + 1)
        order = _suffix_order(text, content, ends)
        suffix = lambda i: (text[i : ends[content[i]]].tolist(), content[i])
        assert order.tolist() == sorted(range(len(text)), key=lambda i: ([*suffix(i)[0], 0], content[i]))
        known = boundaries(order, text, length)

        def common(i, j):
            a, b = suffix(i)[0], suffix(j)[0]
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        assert known.tolist() == [True, *(common(a, b) < length for a, b in zip(order, order[1:])), True]


def test_repeated_strings_of_a_block():
    rng = random.Random(3)
    for length in (1, 4, 30):
        for _ in range(40):
            contents = sorted(set(passages(rng, 9, b"abc\x00\xff", 20)))
            counts = np.array([rng.choice([1, 1, 2]) for _ in contents])
            seen = Counter()
            for c, n in zip(contents, counts):
                seen.update({s: k * int(n) for s, k in Counter(c[i : i + length] for i in range(len(c) - length + 1)).items()})
            got = repeated_strings(contents, counts, length)
            for c, ranges in zip(contents, got):
                marked = {i for a, b in ranges for i in range(a, b)}
                assert marked == {i for i in range(len(c) - length + 1) if seen[c[i : i + length]] > 1}


def test_runs_cover_every_place_once_and_equal_strings_share_anchors():
    rng = random.Random(4)
    data = np.frombuffer(b"".join(passages(rng, 60)), np.uint8)
    starts, sizes, anchors, _ = anchored_runs(data, 40, 10)
    assert starts[0] == 0 and (starts[1:] == starts[:-1] + sizes[:-1]).all() and starts[-1] + sizes[-1] == len(data) - 39
    by = {}
    for start, size, anchor in zip(starts, sizes, anchors):
        for i in range(start, start + size):
            assert by.setdefault(data[i : i + 40].tobytes(), anchor) == anchor


def digests(df):
    return sorted((tuple(r) for r in span_digests(df).collect()), key=repr)


def test_spans_match_brute_force(documents):
    rng = random.Random(5)
    texts = [p.decode("utf-8", "ignore") for p in passages(rng, 50, "abcdé 😀".encode(), 120)]
    texts += ["", None, "short", "x" * 500, "unique " + "".join(chr(rng.randrange(97, 123)) for _ in range(400))] + ["hot passage " * 30] * 40
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    encoded = [(t or "").encode() for _, t in rows]
    for length, anchor in ((50, 16), (60, 20)):
        want = sorted(((i, *d) for (i, _), d in zip(rows, brute_force(encoded, length))), key=repr)
        assert digests(repeated_spans(documents(rows), length=length, anchor=anchor)) == want
        # Nothing changes when blocks are tiny, or when every anchor is settled string by string.
        assert digests(repeated_spans(documents(rows), length=length, anchor=anchor, block_bytes=1, max_anchor_bytes=500)) == want


def test_texts_without_spans(documents):
    rows = [(1, "a" * 30 + "b"), (2, "c" + "a" * 30), (3, "é")]
    out = {r.doc_id: r.text for r in without_spans(repeated_spans(documents(rows), length=30, anchor=8)).collect()}
    assert out == {1: "b", 2: "c", 3: "é"}
    assert repeated_spans(documents([])).collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = sorted(((i, *d) for (i, _), d in zip(rows, brute_force([t for _, t in rows], 200))), key=repr)
    assert sorted(map(tuple, op2_suffix_dedup(spark, sf_dir).collect()), key=repr) == want


def test_order_up_to_a_depth_keeps_its_boundaries():
    rng = random.Random(6)
    for depth in (1, 3, 9, 40):
        contents = sorted({*passages(rng, 12, b"ab", 30), *(b"ab" * 60 + bytes([k]) for k in range(5))})
        sizes = np.array([len(c) for c in contents])
        ends = np.cumsum(sizes + 1) - 1
        text = np.array([x for c in contents for x in [*(b + 1 for b in c), 0]])
        content = np.repeat(np.arange(len(contents)), sizes + 1)
        whole, order = _suffix_order(text, content, ends), _suffix_order(text, content, ends, depth)
        assert sorted(order.tolist()) == list(range(len(text)))
        first = lambda i: text[i : ends[content[i]]].tolist()[:depth]
        assert [first(i) for i in order] == [first(i) for i in whole]
        assert boundaries(order, text, depth).tolist() == boundaries(whole, text, depth).tolist()


def test_bytes_of_contents_that_all_recur_are_not_moved(documents, monkeypatch):
    """Copies have no strings but those their counts have settled, so nothing of them goes to a block."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    staged, moved = suffix_dedup.staged, {}

    def recorded(df, name):
        out = staged(df, name)
        moved[name] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "staged", recorded)
    copies = [t for t in (text(300) for _ in range(12)) for _ in range(3)]
    for texts in (copies, copies + [copies[0][:150] + text(150), copies[5][100:]]):
        rows = list(enumerate(texts))
        want = sorted(((i, *d) for (i, _), d in zip(rows, brute_force([t.encode() for _, t in rows], 50))), key=repr)
        assert digests(repeated_spans(documents(rows), length=50, anchor=16)) == want
        assert (moved["contents"] > 0) == (len(texts) > len(copies))
