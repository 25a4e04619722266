import random
from urllib.parse import unquote

import pytest

from tianguis.llm.queries import op1_warc
from tianguis.llm.staging import new_path
from tianguis.llm.warc import base32_sha1, gzip_member, read_warc, record, salvage, write_warc


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        original = first.get(html or "")
        revisit = len(data) >= least and i != original
        out.append((i, len(data), base32_sha1(data), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=repr)


def found(spark, path):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    out = read_warc(spark, path)
    assert out.filter("kind = 'gap'").count() == 0
    return sorted(map(tuple, out.select(*columns).collect()), key=repr)


ROWS = [
    (1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "ü", "WARC/1.1\r\n\r\n\r\n" * 9),
    (6, "u", "\x1f\x8b\x08" * 5), (7, "u", "é" * 200_000), (7, "u", "é" * 200_000), (None, "u", "same"), (None, "u", "only null"),
    (-8, "u", "same"), (2**62 + 1, "u", "big"),
] + [(100 + i, "u", "hot") for i in range(300)]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, compressed, least):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    path = new_path(spark, "warc")
    write_warc(df, path, min_revisit_bytes=least, compressed=compressed)
    assert found(spark, path) == expected(ROWS, least)


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string, key string, original int, payload int")
    path = new_path(spark, "warc")
    write_warc(df, path)
    assert found(spark, path) == []


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_finds_every_undamaged_record_and_accounts_for_every_byte(compressed):
    rng = random.Random(3)
    separator = gzip_member(b"") if compressed else b"\r\n"
    records = [record(i, "u", bytes(rng.randrange(256) for _ in range(500)), None, False, compressed) for i in range(30)]
    for _ in range(40):
        data, spans, hit = bytearray(), [], set()
        for r in records:
            spans.append((len(data), len(data) + len(r)))
            data += r + separator
        for _ in range(3):
            at = rng.randrange(len(data))
            data[at] ^= 1 << rng.randrange(8)
            hit |= {i for i, (a, b) in enumerate(spans) if a <= at < b}
        cut = rng.randrange(len(data) - 400, len(data))
        del data[cut:]
        hit |= {i for i, (a, b) in enumerate(spans) if b > cut}
        out = list(salvage(bytes(data)))
        got = {r["page_id"] for r in out if r["kind"] == "record"}
        assert set(range(30)) - hit <= got
        # A flipped bit in a header that nothing checks leaves its record readable; none is ever read with a wrong payload.
        assert all(r["payload"] in bytes(records[r["page_id"]]) or compressed for r in out if r["kind"] == "record" and r["page_id"] in range(30))
        covered = sorted((r["offset"], r["offset"] + r["length"]) for r in out)
        assert all(a[1] <= b[0] for a, b in zip(covered, covered[1:]))


def test_junk_before_between_and_after():
    a, b = record(1, None, b"x", None, False), record(2, None, b"y", 1, True)
    out = list(salvage(b"junk" + a + b"\x1f\x8b\x08bad" + b + b"tail"))
    assert [(r["kind"], r["offset"], r["length"]) for r in out] == [
        ("gap", 0, 4), ("record", 4, len(a)), ("gap", 4 + len(a), 6), ("record", 10 + len(a), len(b)), ("gap", 10 + len(a) + len(b), 4),
    ]
    assert [r["reason"] for r in out if r["kind"] == "gap"][0] == "neither member nor version line"
    assert list(salvage(b"")) == []


@pytest.mark.parametrize("compressed", [True, False])
def test_urls_of_any_length_are_read_back(spark, compressed):
    urls = ["data:," + "x" * 100_000, "http://a/" + "é" * 11_000, "http://a/WARC/1.1", "u" * 65_536, "short"]
    rows = [(i, u, f"page {i % 4}") for i, u in enumerate(urls)]
    path = new_path(spark, "warc")
    write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path, compressed=compressed)
    assert found(spark, path) == expected(rows)
    read = {r.page_id: r.target_uri for r in read_warc(spark, path).collect()}
    assert {i: unquote(u) for i, u in read.items()} == dict(enumerate(urls))


def test_headers_without_an_end_stop_at_the_next_record():
    cut, whole = record(1, "u" * 100_000, b"x", None, False, False)[:90_000], record(2, "u" * 100_000, b"y", None, False, False)
    out = list(salvage(cut + b"\r\n" + whole + cut))
    assert [(r["kind"], r["offset"], r["length"]) for r in out] == [("gap", 0, 90_002), ("record", 90_002, len(whole)), ("gap", 90_002 + len(whole), 90_000)]
    assert {r["reason"] for r in out if r["kind"] == "gap"} == {"no end of headers"}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, op1_warc(spark, sf_dir).collect()), key=repr) == expected(rows)
