"""Quality classifier: ridge on random Fourier features of document statistics, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.llm.staging import staged

FEATURES = 256
#: Width of the Gaussian kernel in standard deviations of the statistics.
BANDWIDTH = 3.0
RIDGE = 1.0
SEED = 20
#: At most about so many labelled rows are learned from; beyond, an even sample by the hash of the id.
MAX_TRAINING_ROWS = 200_000
#: Tasks that sum the normal equations, and bins of the calibration: what the driver gets is bounded by them.
SUMMING_TASKS = 16
CALIBRATION_BINS = 1000
THRESHOLD = 0.3


def _bytes(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), list(characters.encode()))


UPPER, LOWER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("abcdefghijklmnopqrstuvwxyz")
CLASSES = [UPPER, LOWER, _bytes("0123456789"), _bytes(" \t\r\x0b\x0c"), _bytes(".,;:?'\"()-"), _bytes("!"), _bytes("#$%&*"), _bytes("|<>[]{}=+~^\\/@_")]


def statistics(text: str) -> list[float]:
    """Shares of byte classes, entropy, and how long, many and varied words and lines are."""
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256).astype(float)
    size = max(counts.sum(), 1.0)
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    letters = max(counts[UPPER].sum() + counts[LOWER].sum(), 1.0)
    present = counts[counts > 0] / size
    return [
        *[float(counts[c].sum() / size) for c in CLASSES],
        float(counts[128:].sum() / size),
        float(counts[UPPER].sum() / letters),
        float(-(present * np.log2(present)).sum()) if len(present) else 0.0,
        float(np.log1p(len(words))),
        len(text) / n if words else 0.0,
        len(set(words)) / n,
        len({*zip(words, words[1:], words[2:])}) / max(len(words) - 2, 1),
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        float(np.log1p(max(map(len, words), default=0))),
    ]


@dataclass(frozen=True)
class Model:
    """Standardisation, random directions, ridge weights and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    bins: np.ndarray
    levels: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, whose products approximate the Gaussian kernel; and a constant."""
        z = np.cos(((x - self.mean) / self.scale) @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lifted(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.bins, self.levels), 0.0, 1.0)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to `values`: pool neighbours that are out of order."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, n = pools.pop()
            u, x, m = pools[-1]
            pools[-1] = [(u * x + v * w) / (x + w), x + w, m + n]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.array([])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, len(statistics(""))))


def fit(labelled: DataFrame, features: int = FEATURES, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learn from rows (doc_id, x, label). Without rows every score is one half.

    Each task sums its part of the normal equations, so the driver gets `SUMMING_TASKS` matrices and solves one system;
    calibration needs labels by bin of the raw score only.
    """
    rng, width = np.random.default_rng(SEED), len(statistics(""))
    model = Model(
        np.zeros(width),
        np.ones(width),
        rng.normal(0, 1 / (BANDWIDTH * np.sqrt(width / 2)), (width, features)),
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        np.array([0.0]),
        np.array([0.5]),
    )
    n = labelled.count()
    if not n:
        return model
    if n > max_rows:
        labelled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * max_rows / n))
    rows = labelled.select("x", "label").repartition(SUMMING_TASKS)
    moments = rows.select(*[F.avg(F.get("x", F.lit(i))) for i in range(width)], *[F.stddev_pop(F.get("x", F.lit(i))) for i in range(width)])
    found = np.array(moments.first(), float)
    scale = np.where(found[width:] > 1e-9, found[width:], 1.0)
    model = Model(found[:width], scale, model.directions, model.phases, model.weights, model.bins, model.levels)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, target = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for batch in batches:
            z = model.lifted(_matrix(batch["x"]))
            both += z.T @ z
            target += z.T @ batch["label"].to_numpy(float)
        yield pd.DataFrame({"both": [both.tobytes()], "target": [target.tobytes()]})

    parts = rows.mapInPandas(sums, "both binary, target binary").collect()
    both = sum(np.frombuffer(p["both"]).reshape(features + 1, features + 1) for p in parts)
    target = sum(np.frombuffer(p["target"]) for p in parts)
    penalty = RIDGE * np.diag([*np.ones(features), 0.0])
    model = Model(model.mean, model.scale, model.directions, model.phases, np.linalg.solve(both + penalty, target), model.bins, model.levels)

    binned = rows.select(F.floor(_raw(model, F.col("x")) * CALIBRATION_BINS).alias("bin"), "label")
    bounded = F.greatest(F.least("bin", F.lit(2 * CALIBRATION_BINS)), F.lit(-CALIBRATION_BINS))
    levels = binned.groupBy(bounded.alias("bin")).agg(F.avg("label").alias("level"), F.count("*").alias("n")).collect()
    levels = sorted((r["bin"], r["level"], r["n"]) for r in levels)
    bins, values, weights = (np.array(c, float) for c in zip(*levels))
    return Model(
        model.mean, model.scale, model.directions, model.phases, model.weights, (bins + 0.5) / CALIBRATION_BINS, isotonic(values, weights)
    )


def _raw(model: Model, x: Column) -> Column:
    return F.pandas_udf(lambda c: pd.Series(model.raw(_matrix(c))), "double")(x)


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    features: int = FEATURES,
    max_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Rows whose crc32 of the id as text is divisible by five, or whose id is null, are held out and never learned from.
    Null text counts as empty. An id that is labelled more than once has the mean of its labels; null labels count for
    nothing. Texts are read once, for statistics that are staged; only those enter a score.
    """

    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    held_out = F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))
    x = F.pandas_udf(measured, "array<double>")(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = staged(df.select(F.col(f"`{id_col}`").alias("doc_id"), held_out.alias("held_out"), x.alias("x")), "statistics")
    known = labels.groupBy(F.col("doc_id")).agg(F.avg(label_col).alias("label")).filter("label IS NOT NULL")
    labelled = staged(rows.filter(~F.col("held_out")).join(known, "doc_id").select("doc_id", "x", "label"), "labelled")
    model = fit(labelled, features, max_rows)
    score = F.pandas_udf(lambda c: pd.Series(model.score(_matrix(c))), "double")(F.col("x"))
    return rows.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
