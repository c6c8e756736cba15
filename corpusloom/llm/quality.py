"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import octets, staged, table
from corpusloom.llm.labelled import held_out, training_rows

#: Labelled rows to learn from, at most.
MOST_LABELS = 20_000
N_FEATURES, RIDGE, SEED = 384, 1e-3, 11
#: One in so many of the training rows calibrates instead.
CALIBRATION = 4

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_PLAIN = b".,;:'\"?-()"
_OTHER = bytes(set(range(33, 127)) - set(_UPPER + _LOWER + _DIGIT + _PLAIN))
_ODD = frozenset(_OTHER)
_CLASSES = np.array([[b in kind for b in range(256)] for kind in (_UPPER, _LOWER, _DIGIT, _SPACE, _PLAIN, _OTHER, bytes(range(128, 256)))], np.float64).T
N_STATISTICS = 18


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of N_STATISTICS numbers for each text; an empty text has zeros."""
    out = np.zeros((len(texts), N_STATISTICS))
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        upper, lower, digit, space, plain, other, high = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
        n, size, lines = len(words), len(text), [x for x in text.split(b"\n") if x.strip()]
        seen = Counter(words)
        letters = upper + lower + high
        ends = sum(w[-1] in _ODD for w in words)
        out[i] = (
            np.log1p(size), np.log1p(n), (size - space) / n, upper / max(letters, 1), digit / size, other / size, plain / size, high / size,
            len(seen) / n, np.log(len(seen)) / np.log(n + 1), sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, max(seen.values()) / n if n > 9 else 0,
            ends / n, sum(len(w) == 1 and w[0] in _ODD for w in words) / n, sum(len(w) < 3 for w in words) / n, text.count(b".") / n,
            1 - len(set(lines)) / len(lines), sum(w.isupper() and len(w) > 1 for w in words) / n,
        )
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The calibrated score; a trace of the raw one orders what the steps of the calibration tie."""
        raw = self.raw(stats)
        return np.clip(0.998 * np.interp(raw, self.knots, self.levels) + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def fourier(z: np.ndarray) -> np.ndarray:
    """Features whose inner product approximates a Gaussian kernel (Rahimi and Recht, 2007), and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], N_FEATURES))
    b = rng.uniform(0, 2 * np.pi, N_FEATURES)
    return np.hstack([np.sqrt(2 / N_FEATURES) * np.cos(np.clip(z, -6, 6) @ w + b), np.ones((len(z), 1))])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the centres and levels of the blocks of the best rising step function. Equal x are one point, so row order doesn't count."""
    places, of = np.unique(x, return_inverse=True)
    weight = np.bincount(of, minlength=len(places)).astype(float)
    means = np.bincount(of, y, len(places)) / np.maximum(weight, 1)
    blocks: list[list[float]] = []  # mean, weight, sum of x
    for place, mean, w in zip(places.tolist(), means.tolist(), weight.tolist(), strict=True):
        blocks.append([mean, w, place * w])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, s = blocks.pop()
            p = blocks[-1]
            p[0], p[1], p[2] = (p[0] * p[1] + m * w) / (p[1] + w), p[1] + w, p[2] + s
    return np.array([s / w for _, w, s in blocks]), np.array([m for m, _, _ in blocks])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, fold: int = 1, most: int = MOST_LABELS) -> QualityModel | None:
    """Learns from the labelled documents outside the held-out fold; None if there are none.

    Each partition sums its part of the normal equations, and the sums, of fixed size, are added up.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(octets(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(list(stats), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = staged(training_rows(docs, labels, label, folds, fold, most).mapInArrow(measure, "doc_id long, y int, x array<double>"), "quality-training").coalesce(16)
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(CALIBRATION)) == 0
    x = [F.get("x", F.lit(i)) for i in range(N_STATISTICS)]
    sums = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    if not sums[0]:
        return None
    mean, scale = np.array(sums[1 : 1 + N_STATISTICS]), np.array(sums[1 + N_STATISTICS :])
    scale[scale < 1e-9] = 1.0

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N_FEATURES + 1, N_FEATURES + 2))
        for batch in batches:
            stats = np.array(batch.column("x").to_pylist()).reshape(-1, N_STATISTICS)
            z = fourier((stats - mean) / scale)
            total += z.T @ np.hstack([z, batch.column("y").to_numpy(zero_copy_only=False)[:, None]])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.filter(~part).select("y", "x").mapInArrow(equations, "sums binary").collect()
    total = sum(np.frombuffer(r.sums).reshape(N_FEATURES + 1, N_FEATURES + 2) for r in parts)
    n = max(total[-1, -2], 1.0)
    penalty = RIDGE * n * np.eye(N_FEATURES + 1)
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])
    model = QualityModel(mean, scale, beta, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    seen = rows.filter(part).select("y", "x").collect()  # at most the bounded sample
    if seen:
        knots, levels = isotonic(model.raw(np.array([r.x for r in seen])), np.array([float(r.y) for r in seen]))
        model = QualityModel(mean, scale, beta, knots, levels)
    return model


def quality_score(model: QualityModel | None) -> Column:
    """The score of the column `text`; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(octets(text))))

    return score(F.col("text"))


def classify_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, most: int = MOST_LABELS) -> DataFrame:
    """Returns doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, one row for each document.

    Only statistics of the whole text are inputs. A null text scores as an empty one; a null doc_id is in the fold of
    the empty id; repeated rows score alike; no documents give no rows; without training labels every
    score is 0.5. Other columns are ignored.
    """
    score = quality_score(fit_quality(docs, labels, "quality", folds, fold, most))
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select("doc_id", held_out(folds, fold).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_rejected(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, most: int = MOST_LABELS) -> DataFrame:
    """The documents that score 0.5 or more, with all their columns; nothing is shuffled."""
    return docs.filter(quality_score(fit_quality(docs, labels, "quality", folds, fold, most)) >= 0.5)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
