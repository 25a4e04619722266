import hashlib
from collections import defaultdict

from tianguis.llm.exact_dedup import exact_duplicates

LOWER = {c: c + 32 for c in range(65, 91)}


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True):
            out.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
            first = False
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_groups_match_brute_force(documents):
    long = "abcdefgh" * 400
    rows = [
        (1, "Same"), (2, "sAME"), (3, None), (4, ""), (5, "ÄB"), (6, "äb"), (7, "ÄB"),
        (8, long), (9, long), (10, long + "x"), (11, long + "y"), (12, long[:64]), (13, long[:64]), (14, long[:1088]),
        (15, long[:1088]), (16, "same"), (16, "same"), (None, "same"), (None, "n"), (None, "n"), (-5, "z\x00"), (20, "z"),
    ] + [(100 + i, "hot group " * 30) for i in range(200)]
    assert found(exact_duplicates(documents(rows))) == expected(rows)
    assert found(exact_duplicates(documents(rows), first_width=1, growth=2)) == expected(rows)


def test_empty_table_and_clashing_names(spark, documents):
    assert exact_duplicates(documents([])).collect() == []
    rows = [(1, "a", "x", "y", 1), (2, "A", "x", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grp string, head string, place int")
    out = exact_duplicates(df, carry=True).filter("kept").select("row.*")
    assert out.columns == df.columns
    assert [r.doc_id for r in out.collect()] == [2]
