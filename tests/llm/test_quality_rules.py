import random

import pytest
import reference

from tianguis.llm.quality_rules import quality_rules

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(df, rows):
    got = {}
    for r in df.collect():
        got.setdefault(r.doc_id, []).append((tuple(r[c] for c in COLUMNS), r.kept))
    want = {}
    for (i, text, lang), kept in zip(rows, reference.quality_kept(rows)):
        want.setdefault(i, []).append((reference.surface(text), kept))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    check(quality_rules(docs), rows)
    assert 0 < sum(reference.quality_kept(rows)) < len(rows)


def test_edge_cases(documents):
    rng = random.Random(1)
    words = ["a", "b", "c", "d|", "é#", "😀"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(200))), "en") for i in range(40)]
    rows += [(100 + i, t, None) for i, t in enumerate([None, "", " \n\t", "x", "x y", "a b c a b c", "a\na\n \n\na\r\na", "\x0b\x0c\x1c\x85 z"])]
    rows += [(200, "the cat " * 5000, "en"), (200, "the cat " * 5000, "en"), (None, "lone words here", "xx")]
    check(quality_rules(documents(rows)), rows)


def test_empty_table_and_clashing_names(spark, documents):
    assert quality_rules(documents([])).collect() == []
    df = spark.createDataFrame([(1, "t", "en", 1, 2)], "doc_id long, text string, lang string, n_words int, classes int")
    assert quality_rules(df, carry=True).select("row.*").columns == df.columns


@pytest.mark.parametrize("language", ["en", "fr"])
def test_only_texts_unlike_their_language_diverge(documents, language):
    rng = random.Random(2)
    from tianguis.llm.quality_rules import COMMON_WORDS

    like = lambda: " ".join(rng.choice(COMMON_WORDS[language] + [f"word{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(16)]) for _ in range(400))
    rows = [(i, like(), language) for i in range(30)] + [(99, " ".join(f"{i * 7919}#{i}" for i in range(400)), language)]
    kept = {r.doc_id for r in quality_rules(documents(rows)).filter("kept").collect()}
    assert 99 not in kept and len(kept) >= 29 - 1


def prose(rng, commons, share, n=400):
    """Words that no list holds, and `share` of them from `commons`."""
    other = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(7))
    return " ".join(rng.choice(commons) if rng.random() < share else other() for _ in range(n))


@pytest.mark.parametrize("language", ["en", "de", "fr", "es"])
@pytest.mark.parametrize("share", [0.17, 0.3])
def test_the_word_rule_alone_rejects_a_text_without_common_words(documents, language, share):
    from tianguis.llm.quality_rules import COMMON_WORDS, MAX_CHARACTER_DISTANCE

    rng = random.Random(7)
    rows = [(i, prose(rng, COMMON_WORDS[language], share), language) for i in range(60)] + [(99, prose(rng, [], 0), language)]
    got = {r.doc_id: r for r in quality_rules(documents(rows)).collect()}
    assert not got[99].kept and not got[99].base_failed and got[99].character_distance < MAX_CHARACTER_DISTANCE / 2
    assert all(got[i].kept for i in range(60))
