import zlib

import numpy as np

from tianguis.llm.quality_classifier import CALIBRATION_BINS, RIDGE, fit, isotonic, quality_scores, statistics


def test_isotonic():
    assert isotonic(np.array([1.0, 3, 2, 2, 5]), np.array([1.0, 1, 1, 2, 1])).tolist() == [1, 2.25, 2.25, 2.25, 5]
    assert isotonic(np.array([]), np.array([])).tolist() == []
    assert isotonic(np.array([3.0, 2, 1]), np.ones(3)).tolist() == [2, 2, 2]


def test_held_out_documents_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in out.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in out.values())
    test = [(r.quality, out[r.doc_id]) for r in labels.collect() if out[r.doc_id].held_out]
    assert np.mean([q == r.predicted for q, r in test]) >= 0.9


def test_nulls_repeats_and_empty_tables(spark, documents):
    rows = [(None, None), (1, ""), (1, ""), (2, "a " * 1000), (3, "퟿😀" * 100_000)]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    out = quality_scores(documents(rows), labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [True]
    none = labels.limit(0)
    assert {r.score for r in quality_scores(documents(rows), none).collect()} == {0.5}
    assert quality_scores(documents([]), none).collect() == []


def test_weights_are_those_of_a_plain_ridge_regression(spark):
    """Standardised rows, Fourier features and normal equations against numpy on all rows at once."""
    rng, width = np.random.default_rng(5), len(statistics(""))
    x = rng.normal(3, 2, (400, width))
    y = (x[:, 0] + 0.5 * x[:, 1] > 4.5).astype(int)
    rows = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y))], "doc_id long, x array<double>, label int")
    model = fit(rows, features=32)
    standard = (x - x.mean(0)) / x.std(0)
    z = np.sqrt(2 / 32) * np.cos(standard @ model.directions + model.phases)
    z = np.column_stack([z, np.ones(len(x))])
    # Ridge as least squares with one more row per weight; the constant is not held down.
    more = np.sqrt(RIDGE) * np.eye(33)[:32]
    weights = np.linalg.lstsq(np.vstack([z, more]), np.concatenate([y, np.zeros(32)]), rcond=None)[0]
    assert np.allclose(model.weights, weights, atol=1e-6)
    assert np.allclose(model.raw(x), z @ weights, atol=1e-6)
    assert (np.diff(model.levels) >= 0).all()
    bins = np.floor(z @ weights * CALIBRATION_BINS)
    assert np.isclose(sum(model.levels[np.searchsorted(model.bins, (b + 0.5) / CALIBRATION_BINS - 1e-9)] for b in bins), y.sum(), atol=1e-6)
