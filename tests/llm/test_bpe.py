import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tianguis.llm.bpe import WordBpe, bpe_digests, bpe_round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")
THEIRS = Tokenizer.from_file(PATH)
OURS = WordBpe(PATH)


def expected(text):
    ids = THEIRS.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), THEIRS.decode(ids, skip_special_tokens=False)


TEXTS = [
    "", " \n\t", "Hello, World! it's we'll I'M 2024", "ΑΣ ΟΔΟΣ Σ", "İstanbul ŉ ß ẞ", "é Å ﬁ", "<|endoftext|>x<|startoftext|> <|endoftext",
    "\x1c a\x85b\xa0c　d​e", "漢字 かな 한글 😀👍🏽 नमस्ते", "a" * 5000, "ab" * 3000 + "'s", "\x00\x01", "x²½Ⅷ٣", "'S'T'RE", "Ǆ ǅ ﷺ",
]


@pytest.mark.parametrize("text", TEXTS)
def test_like_the_library(text):
    assert tuple(OURS.encode(text)) == expected(text)


@given(st.text(max_size=60) | st.text(alphabet="aábtheinrs'.,<|> \n19ßÉΣ", max_size=60))
@settings(max_examples=400, deadline=None)
def test_like_the_library_on_any_text(text):
    assert tuple(OURS.encode(text)) == expected(text)
    assert OURS.decode(list(map(int, OURS.encode(text).ids.split()))) == OURS.encode(text).tokens


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: expected(r.text) for r in docs.collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {r.doc_id: tuple(r)[1:] for r in bpe_round_trip(docs, PATH).collect()} == want
    assert {r.doc_id: tuple(r)[1:] for r in bpe_digests(docs, PATH).collect()} == {i: (n, sha(a), sha(b)) for i, (n, a, b) in want.items()}


def test_nulls_repeats_and_empty_table(documents):
    df = documents([(None, None), (1, "a"), (1, "a"), (2, "")])
    assert sorted(map(tuple, bpe_round_trip(df, PATH).collect()), key=repr) == [(1, *expected("a"))] * 2 + [(2, 0, "", ""), (None, 0, "", "")]
    assert bpe_digests(documents([]), PATH).count() == 0
