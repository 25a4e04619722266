"""The pipeline against brute-force versions of its stages, one after the other."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import reference
from test_near_dedup import brute_force as near_links
from test_packing import check, expected_ids, expected_pieces

from tianguis.llm.secrets import _cut, find_spans


def without_secrets(text):
    spans = [{"start": s, "end": e} for _, s, e, _ in find_spans(text)]
    return _cut(text, spans, "[SECRET]")


def test_stages_match_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "near_dedup", "secret_scans", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    rows = [r for r, kept in zip(rows, reference.quality_kept(rows)) if kept]
    found = stage["quality_rules"](spark, docs, sf_dir)
    assert found.schema == docs.schema and sorted(r.doc_id for r in found.collect()) == sorted(r[0] for r in rows)

    rows = reference.exact_kept(rows)
    found = stage["exact_dedup"](spark, found, sf_dir)
    assert found.schema == docs.schema and sorted(r.doc_id for r in found.collect()) == sorted(r[0] for r in rows)

    links = near_links([r[:2] for r in rows])
    rows = [r for r in rows if links[r[0]][1] == r[0]]
    found = stage["near_dedup"](spark, found, sf_dir)
    assert found.schema == docs.schema and sorted(r.doc_id for r in found.collect()) == sorted(r[0] for r in rows)

    found = stage["secret_scans"](spark, found, sf_dir)
    texts = {r.doc_id: r.text for r in found.collect()}
    assert found.columns == docs.columns and [t for _, t in found.dtypes] == [t for _, t in docs.dtypes]
    # A token seen with many owners is not live; these tables have none, so the spans of one text decide.
    assert texts == {r[0]: without_secrets(r[1]) for r in rows}
    assert any("[SECRET]" in t for t in texts.values())

    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected_pieces(texts.items(), 2048)
    check(packed, 2048)


def test_the_last_stage_returns_the_ids(spark, documents, tmp_path):
    rows = [(i, " ".join(f"w{i}" for _ in range(i * 900))) for i in range(4)]
    got = corpus_pipeline.packing(spark, documents(rows), str(tmp_path)).orderBy("doc_id", "start").collect()
    found = {}
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        found[r.doc_id] = found.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert found == expected_ids(rows)


def test_empty_documents(spark, documents, tmp_path):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_nulls_everywhere(spark, documents, tmp_path):
    docs = documents([(None, None, None, None)] * 3 + [(1, "good words of many kinds " + " ".join(f"w{i}" for i in range(80)), None, None)])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert {r.doc_id for r in docs.collect()} == {1}


