import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tianguis.llm.packing import pack, pack_documents, plan_bins, sequence_pieces, sequences, token_pieces
from tianguis.llm.queries import op3_best_fit_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best-two-fit on single documents."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        bin_ = [left.pop(0)]
        while (fits := [x for x in left if x <= capacity - sum(bin_)]):
            bin_.append(max(fits))
            left.remove(max(fits))
        gap = capacity - sum(bin_)
        if gap and len(bin_) > 1:
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= gap + bin_[-1]]
            if pairs and max(pairs)[0] > bin_[-1]:
                _, a, b = max(pairs)
                left.append(bin_.pop())
                for x in (a, b):
                    left.remove(x)
                    bin_.append(x)
                left.sort(reverse=True)
        bins.append(sum(bin_))
    return sorted(bins)


def test_plan_equals_packing_one_by_one():
    rng = random.Random(5)
    for trial in range(60):
        capacity = rng.choice([7, 20, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(90))]
        patterns = list(plan_bins(Counter(lengths), capacity))
        assert Counter(x for p in patterns for x in p.lengths * p.times) == Counter(lengths)
        assert all(sum(p.lengths) <= capacity for p in patterns)
        assert sorted(sum(p.lengths) for p in patterns for _ in range(p.times)) == one_by_one(lengths, capacity)


def check(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_rows_are_all_placed_once(spark):
    rng = random.Random(2)
    lengths = [rng.choice([1, 2, 3, 5, 8, 13, 16, 16, 16]) for _ in range(500)] + [7] * 400
    df = spark.createDataFrame([(i // 2 if i % 7 else None, n, "x") for i, n in enumerate(lengths)], "doc_id long, length long, offset0 string")
    out = pack(df, 16).collect()
    assert Counter((r.doc_id, r.length) for r in out) == Counter((r.doc_id, r.length) for r in df.collect())
    assert check(out, 16) == len(one_by_one(lengths, 16))


def test_empty_table(documents):
    assert pack_documents(documents([]), PATH).count() == 0


def expected_pieces(texts, capacity):
    theirs = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in texts:
        ids = np.array([*theirs.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    return Counter(out)


def test_pieces_and_sequences(documents):
    rows = [(1, None), (2, ""), (3, "word " * 300), (3, "word " * 300), (None, "ÉÉ<|endoftext|> ß"), (4, "x" * 3000)]
    df = documents(rows)
    packed = pack(token_pieces(df, PATH, capacity=64), 64)
    got = packed.collect()
    crc = lambda ids: zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())
    assert Counter((r.doc_id, r.piece, r.start, r.length, crc(r.ids)) for r in got) == expected_pieces(rows, 64)
    check(got, 64)
    for r in sequences(packed, "<u2").collect():
        assert len(r.ids) == 4 * r.length <= 256
    # Beyond the bound of the broadcast, rows meet the counts by a shuffle and lie as well.
    far = pack(token_pieces(df, PATH, capacity=64), 64, max_broadcast=0)
    assert "BroadcastHashJoin" not in far._jdf.queryExecution().optimizedPlan().toString()
    got = far.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, crc(r.ids)) for r in got) == expected_pieces(rows, 64)
    check(got, 64)


def test_ids_move_once(spark, documents):
    """One shuffle has rows with ids: the one that brings the pieces of a sequence together."""
    packed = pack_documents(documents([(i, f"w{i} " * 40) for i in range(30)]), PATH, capacity=64)
    packed.collect()
    plan = packed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    keys = re.findall(r"Exchange hashpartitioning\((\w+?)#", plan)
    assert [k for k in keys if k not in ("length", "_task")] == ["sequence_id"]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_names_that_are_made_here_are_refused(spark):
    for name in ("sequence_id", "offset", "_before", "_task"):
        with pytest.raises(ValueError, match=name):
            pack(spark.createDataFrame([(3, 1)], f"length long, {name} long"), 8)


def expected_ids(texts):
    theirs = Tokenizer.from_file(PATH)
    return {i: [*theirs.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts}


def test_packed_sequences_hold_the_ids_of_every_document(documents):
    rows = [(1, None), (2, ""), (3, "word " * 300), (5, "ÉÉ<|endoftext|> ß"), (4, "x" * 3000)]
    want = expected_ids(rows)
    packed = pack_documents(documents(rows), PATH, capacity=64)
    found = {}
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length == sum(p.length for p in r.pieces) <= 64
        for p in r.pieces:
            found[p.doc_id, p.start] = ids[p.offset : p.offset + p.length]
    assert {i: sum((found[k] for k in sorted(found) if k[0] == i), []) for i in want} == want
    cut = {(r.doc_id, r.start): np.frombuffer(r.ids, "<u4").tolist() for r in sequence_pieces(packed).collect()}
    assert cut == found


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op3_best_fit_packing(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected_pieces(texts, 2048)
    n = check(got, 2048)
    assert n <= -(-sum(r.length for r in got) // 2048) + 1  # one over the volume bound, which need not be reachable
