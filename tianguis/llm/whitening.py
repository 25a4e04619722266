"""Whitening of embeddings by shifted CholeskyQR: distributed Gram passes over rows that are never gathered."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: An entry c is taken as the whole number floor(64 * c) + 1000000, so sums over rows are exact.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows that a task holds as doubles at a time.
ROWS_AT_ONCE = 4096
#: Passes over the rows at most; three do for full rank, further ones only tell vanishing directions from small ones.
MAX_PASSES = 8
#: A Gram matrix this near to the identity comes from orthonormal columns.
ORTHONORMAL = 1e-13
#: Directions with less than this part of the largest deviation, for each dimension, have no variance beyond rounding.
VANISHING = 2.0**-48


class Moments(NamedTuple):
    """Rows and sums by dimension of the fit list."""

    n: int
    sums: np.ndarray


class Whitening(NamedTuple):
    """The fitted transform: `components` has a column for each, `eigenvalues` fall, `explained` are parts of the trace."""

    moments: Moments
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whole_numbers(vector: Column) -> Column:
    """floor(64 * c) + 1000000 of each entry, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    c = lambda x: x.cast("double")
    finite = lambda x: x.isNotNull() & ~F.isnan(c(x)) & (F.abs(c(x)) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def fit_list(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the vector in whole numbers; unusable rows are left out."""
    vector = F.col(f"`{vector_col}`")
    # Entries are only converted where all are finite, in whatever order the optimizer puts filters.
    x = F.when(usable(vector), whole_numbers(vector))
    return df.select(F.col(f"`{id_col}`").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull())


def moments(rows: DataFrame) -> Moments:
    """Exact counts and sums; vectors of different lengths are an error. One line for each dimension comes back."""
    kinds = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if kinds["n"] == 0:
        return Moments(0, np.zeros(0, np.int64))
    if kinds["low"] != kinds["high"]:
        raise ValueError(f"vectors of {kinds['low']} to {kinds['high']} entries in one table")
    sums = rows.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum("c").alias("s")).collect()
    return Moments(kinds["n"], np.array([r["s"] for r in sorted(sums, key=lambda r: r["at"])], np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column, without nulls, as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _centred(x: np.ndarray, fitted: Moments) -> np.ndarray:
    """x - S / n, from the exact whole number n * x - S."""
    return (fitted.n * x - fitted.sums) / float(fitted.n)


def _solved(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """y R^-1 for an upper triangular R, column by column."""
    q = np.empty_like(y)
    for j in range(y.shape[1]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _gram(rows: DataFrame, fitted: Moments, factors: Sequence[np.ndarray], projection: np.ndarray | None = None) -> np.ndarray:
    """Q^T Q of the centred rows Q = Y R1^-1 R2^-1 .. (or of Y times a projection).

    A task adds up its blocks of rows and hands on one matrix, whose entries Spark adds up over all tasks; only their sums,
    as many as a Gram matrix has, reach the driver. Rows are computed from the table again in each pass, so nothing is kept
    that a lost executor could take with it.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for first in range(0, len(batch), ROWS_AT_ONCE):
                q = _centred(_matrix(batch.column(0).slice(first, ROWS_AT_ONCE)), fitted)
                for r in factors:
                    q = _solved(q, r)
                if projection is not None:
                    q = q @ projection
                total = total + q.T @ q
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["g"])

    parts = rows.select("x").mapInArrow(blocks, "g array<double>")
    sums = parts.select(F.posexplode("g").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    width = len(fitted.sums) if projection is None else projection.shape[1]
    flat = np.zeros(width * width)
    flat[[r["at"] for r in sums]] = [r["v"] for r in sums]
    return flat.reshape(width, width)


def _factor(gram: np.ndarray, n: int) -> np.ndarray:
    """The upper Cholesky factor, of the shifted matrix where rounding may have taken away its definiteness."""
    d = len(gram)
    scale = float(np.linalg.norm(gram, 2))
    shift = 11 * (n * d + d * (d + 1)) * 2.0**-53 * scale
    low = float(np.linalg.eigvalsh(gram)[0])
    # With a condition below this the factor is sound without a shift.
    if low > shift and low > scale * 1e-8:
        return np.linalg.cholesky(gram).T
    return np.linalg.cholesky(gram + max(shift, scale * 1e-14) * np.eye(d)).T


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Unit eigenvectors of the covariance of `rows` (of `fit_list`), by falling eigenvalue, `components` at most.

    Shifted CholeskyQR: the Gram matrix of the centred rows, plus a shift that keeps it positive definite, gives a
    triangular R1; the rows times its inverse are better conditioned and go through the same pass again, until they are
    orthonormal. The product R of the factors has the singular values of the centred rows, and its right singular vectors
    are the components; the covariance itself, whose condition is the square, is never decomposed. Dimensions without any
    variance are left out of the passes, as their sums tell exactly. Other directions that have none beyond rounding are
    no components: they cannot be scaled to unit variance.
    """
    fitted = moments(rows)
    d = len(fitted.sums)
    if fitted.n == 0 or d == 0:
        return Whitening(fitted, np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    spread = rows.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg((F.max("c") > F.min("c")).alias("varies")).collect()
    alive = np.array([r["varies"] for r in sorted(spread, key=lambda r: r["at"])])
    if not alive.any():
        return Whitening(fitted, np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    live = [int(i) for i in np.flatnonzero(alive)]
    part = rows if alive.all() else rows.select(F.array(*[F.col("x")[i] for i in live]).alias("x"))
    moved = Moments(fitted.n, fitted.sums[live])
    factors: list[np.ndarray] = []
    whole = np.eye(len(live))
    for _ in range(MAX_PASSES):
        gram = _gram(part, moved, factors)
        if factors and np.abs(gram - np.eye(len(live))).max() < ORTHONORMAL * len(live):
            break
        factors.append(_factor(gram, fitted.n))
        whole = factors[-1] @ whole
    _, singular, right = np.linalg.svd(whole)
    values = singular**2 / fitted.n
    count = min(components, int((singular > singular[0] * len(live) * VANISHING).sum()))
    vectors = np.zeros((d, count))
    vectors[live] = right[:count].T
    return Whitening(fitted, vectors, values[:count], values[:count] / values.sum())


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry by which the covariance of the whitened rows differs from the identity; 0 without components."""
    if not len(fitted.eigenvalues):
        return 0.0
    gram = _gram(rows, fitted.moments, [], fitted.components / np.sqrt(fitted.eigenvalues))
    return float(np.abs(gram / fitted.moments.n - np.eye(len(gram))).max())


def whitened(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened vector of every row of `rows`.

    The deviation is the sum over dimensions of (n * x - S)^2, exact; one beyond a long is an error.
    """
    projection = fitted.components / np.sqrt(fitted.eigenvalues)
    given = fitted.moments

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), ROWS_AT_ONCE):
                some = batch.slice(first, ROWS_AT_ONCE)
                exact = given.n * _matrix(some.column(1)) - given.sums
                if len(exact) and float((exact.astype(float) ** 2).sum(axis=1).max()) > 9.2e18:
                    raise OverflowError("a deviation does not fit a long")
                out = (exact / float(given.n)) @ projection
                values = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1, dtype=np.int32) * out.shape[1]), pa.array(np.ascontiguousarray(out).ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array((exact**2).sum(axis=1), pa.int64()), values], ["vec_id", "deviation", "whitened"]
                )

    kind = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL("deviation long, whitened array<double>").fields])
    return rows.select("vec_id", "x").mapInArrow(project, kind)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every usable row and component.

    Rows whose vector is null or holds null or non-finite entries are left out. All other rows are fitted and given back,
    rows that repeat as often as they come, with null ids as they are; columns besides the two, whatever their names, are
    not read. An empty table, or one without any variance, gives an empty result. Vectors of different lengths are an error.
    The input is read once for each pass.
    """
    rows = fit_list(df, id_col, vector_col)
    fitted = fit_whitening(rows, components)
    error = identity_error(rows, fitted)
    explained = F.array(*[F.lit(float(e)) for e in fitted.explained]).cast("array<double>")
    return whitened(rows, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(fitted.moments.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
