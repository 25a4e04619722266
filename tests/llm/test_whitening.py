import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tianguis.llm import queries
from tianguis.llm.whitening import fit_list, fit_whitening, identity_error, whiten

SF_DIR = "/root/testdata/sf0.001"


def frame(spark, tmp_path, rows, kind="array<float>", parts=3):
    path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
    spark.createDataFrame(rows, f"vec_id long, embedding {kind}, x int, whitened string").repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def vectors(matrix):
    return [(i, [float(c) for c in v], 1, "other") for i, v in enumerate(matrix)]


def whole(vector):
    return [math.floor(64 * float(c)) + 1000000 for c in vector]


def compare(result, kept, components):
    """Against exact sums and the eigenvectors of the covariance."""
    x = [(i, whole(v)) for i, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*[v for _, v in x])]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for _, v in x])
    values, right = np.linalg.eigh(y.T @ y / n)
    values, right = values[::-1][:components], right[:, ::-1][:, :components]
    expected = y @ right / np.sqrt(values)
    rows = result.collect()
    assert len(rows) == n * components
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    got = np.zeros((n, components))
    at = {i: k for k, (i, _) in enumerate(x)}
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[at[r.vec_id]][1], sums))
        assert r.explained == pytest.approx(values[r.component - 1] / (y**2).sum() * n, rel=1e-9)
    signs = np.sign((got * expected).sum(axis=0))
    assert np.allclose(got * signs, expected, atol=1e-7)


def test_query_agrees_with_the_eigenvectors_of_the_covariance(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    result = queries.op13_embedding_whitening(spark, SF_DIR)
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(result, kept, 32)


def test_unusable_rows_are_left_out(spark, tmp_path):
    rng = np.random.default_rng(1)
    good = vectors(rng.normal(size=(40, 4)))
    bad = [(100, None, 1, ""), (101, [1.0, None, 2.0, 3.0], 1, ""), (102, [1.0, math.nan, 0.0, 0.0], 1, ""), (103, [math.inf, 0.0, 0.0, 0.0], 1, "")]
    df = frame(spark, tmp_path, good + bad)
    compare(whiten(df), [(r[0], [np.float32(c) for c in r[1]]) for r in good], 4)


def test_badly_scaled_dimensions(spark, tmp_path):
    """A condition of 1e8, whose square a double cannot hold in one Cholesky factor."""
    rng = np.random.default_rng(2)
    # Eigenvectors of nearly diagonal covariances are compared by their covariance, which has to be the identity.
    matrix = rng.normal(size=(500, 6)) * [1e9, 1e7, 1e5, 1e3, 1e2, 10]
    rows = fit_list(frame(spark, tmp_path, vectors(matrix), "array<double>"))
    fitted = fit_whitening(rows)
    assert len(fitted.eigenvalues) == 6 and identity_error(rows, fitted) < 1e-6
    x = np.array([whole(v) for v in matrix], float)
    assert np.allclose(np.sqrt(fitted.eigenvalues), np.linalg.svd(x - x.mean(axis=0))[1] / math.sqrt(500), rtol=1e-6)


def test_directions_without_variance_are_no_components(spark, tmp_path):
    rng = np.random.default_rng(3)
    base = rng.integers(-500, 500, size=(300, 3)) / 64
    # A constant dimension, a copy and an exact sum: three directions vary.
    matrix = np.column_stack([base, np.full(300, 2.5), base[:, 0], base[:, 0] + base[:, 1]])
    df = frame(spark, tmp_path, vectors(matrix), "array<double>")
    rows = fit_list(df)
    fitted = fit_whitening(rows)
    assert len(fitted.eigenvalues) == 3 and identity_error(rows, fitted) < 1e-9
    assert sum(fitted.explained) == pytest.approx(1)
    assert whiten(df).count() == 900


def test_edges(spark, tmp_path):
    df = frame(spark, tmp_path, vectors([[1.0, 2.0]] * 5))
    assert whiten(df).collect() == []  # no variance at all
    assert whiten(df.filter("vec_id > 100")).collect() == []
    assert whiten(frame(spark, tmp_path, [(1, None, 1, "")])).collect() == []
    assert whiten(frame(spark, tmp_path, vectors([[]] * 3))).collect() == []
    repeated = frame(spark, tmp_path, [(None, [0.0], 1, ""), (None, [0.0], 1, ""), (3, [1.0], 1, ""), (3, [1.0], 1, "")])
    got = whiten(repeated).select("vec_id", "component", "n", "deviation", F.round(F.abs("whitened"), 9).alias("w")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 1, 4, 128**2, 1.0)] * 2 + [(3, 1, 4, 128**2, 1.0)] * 2, key=repr)
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whiten(frame(spark, tmp_path, vectors([[1.0], [1.0, 2.0]])))
    huge = frame(spark, tmp_path, vectors([[0.0], [1e9]]), "array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        whiten(huge).collect()
