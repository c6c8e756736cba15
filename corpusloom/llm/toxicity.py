"""Toxicity classifier with a counterfactual penalty.

Logistic regression on the presence of words and word beginnings. Each labelled text that mentions an identity term
has a counterfactual in which the terms are swapped for others of their kind; the squared change of the log odds is
part of the loss, so a mention by itself can't carry weight (after Garg and others, 2019).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import octets, staged, table
from corpusloom.llm.labelled import held_out, training_rows

#: Labelled rows to learn from, and features to keep, at most.
MOST_LABELS, MOST_FEATURES = 20_000, 1024
#: A feature is in so many training documents at least.
LEAST_DOCUMENTS = 4
PENALTY, COUNTERFACTUAL, STEPS = 0.3, 10.0, 8
#: Tasks that sum a step up, over MOST_LABELS rows at most, and sums in a row of what they send to the driver (256 KB).
TASKS, SENT = 4, 1 << 15
#: Identity terms by kind, of the corpus's four languages; a term is swapped for the next one of its kind, the last for the first.
IDENTITY = (
    # English
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"), ("black", "white", "asian", "latino", "indigenous"),
    ("immigrant", "native"), ("immigrants", "natives"), ("disabled", "blind", "deaf"), ("old", "young"),
    # German
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwule", "lesben"), ("schwul", "lesbisch", "bisexuell"), ("schwarze", "weiße"), ("ausländer", "inländer"), ("einwanderer", "einheimische"),
    ("behinderte", "blinde", "gehörlose"), ("alte", "junge"),
    # Spanish
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos", "budistas", "ateos"), ("musulmán", "cristiano", "judío"),
    ("lesbianas", "gais"), ("negros", "blancos", "asiáticos"), ("negro", "blanco"), ("inmigrantes", "nativos"), ("discapacitados", "ciegos", "sordos"), ("viejos", "jóvenes"),
    # French
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"), ("musulman", "chrétien", "juif"),
    ("lesbiennes", "homosexuels"), ("noirs", "blancs", "asiatiques"), ("immigrés", "natifs"), ("handicapés", "aveugles", "sourds"), ("vieux", "jeunes"),
)


def swaps(identity: Sequence[Sequence[str]]) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for kind in identity for a, b in zip(kind, [*kind[1:], kind[0]], strict=True)}


SWAP = swaps(IDENTITY)
#: Letters, digits and all bytes of other scripts stay; the rest parts words.
_PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes) -> set[bytes]:
    return set(text.lower().translate(_PARTS).split())


def features_of(words: set[bytes], swap: dict[bytes, bytes] = SWAP) -> set[bytes]:
    """The words, and their first 4 to 9 bytes marked by a caret; identity terms only as whole words."""
    out = set(words)
    for w in words:
        if w not in swap:
            for n in range(4, min(len(w), 10)):
                out.add(b"^" + w[:n])
    return out


def swapped(words: set[bytes], swap: dict[bytes, bytes] = SWAP) -> set[bytes]:
    """The words with each identity term replaced; with all terms of a kind in a text, that changes nothing."""
    return {swap.get(w, w) for w in words}


@dataclass(frozen=True)
class ToxicityModel:
    features: dict[bytes, int]
    weights: np.ndarray  # the last is the constant
    swap: dict[bytes, bytes]
    counterfactuals: int  # training rows that mention an identity term

    def logit(self, words: set[bytes]) -> float:
        get = self.features.get
        return float(self.weights[-1] + sum(self.weights[i] for f in features_of(words, self.swap) if (i := get(f)) is not None))

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(words_of(text)), -40, 40))))


def _counts(batches: Iterator[pa.RecordBatch], swap: dict[bytes, bytes]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other documents of the partition have each feature."""
    toxic: Counter[bytes] = Counter()
    other: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        keys = list(toxic.keys() | other.keys())
        return pa.RecordBatch.from_pydict({"feature": pa.array(keys, pa.binary()), "toxic": pa.array([toxic[k] for k in keys], pa.int64()), "other": pa.array([other[k] for k in keys], pa.int64())})

    for batch in batches:
        for text, y in zip(octets(batch.column("text")), batch.column("y").to_pylist(), strict=True):
            (toxic if y else other).update(features_of(words_of(text), swap))
        if len(toxic) + len(other) > 1 << 19:
            yield out()
            toxic.clear()
            other.clear()
    yield out()


def _vocabulary(rows: DataFrame, most: int, swap: dict[bytes, bytes]) -> list[bytes]:
    """The features that tell toxic documents best, by the G statistic of their counts; identity terms always."""
    totals = rows.agg(F.sum(F.col("y")), F.sum(1 - F.col("y"))).first()
    n1, n0 = float(totals[0] or 0), float(totals[1] or 0)
    counts = rows.select("text", "y").mapInArrow(lambda batches: _counts(batches, swap), "feature binary, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    share = (F.col("a") + F.col("b")) / F.lit(max(n1 + n0, 1.0))
    term = lambda k, n: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (share * F.lit(max(n, 1e-9))))).otherwise(0.0)
    strength = term("a", n1) + term("b", n0)
    best = counts.filter(F.col("a") + F.col("b") >= LEAST_DOCUMENTS).withColumn("g", strength).filter(F.col("a") * F.lit(n0) > F.col("b") * F.lit(n1))
    best = best.orderBy(F.desc("g"), "feature").limit(most).select("feature").collect()
    return list(dict.fromkeys([*swap, *(bytes(r.feature) for r in best)]))


def sums_sent(grad: np.ndarray, hess: np.ndarray) -> pa.RecordBatch:
    """The gradient and the upper triangle of the Hessian, which is symmetric: at, sums, in rows of SENT sums at most."""
    sums = np.concatenate([grad, hess[np.triu_indices(len(grad))]])
    at = range(0, len(sums), SENT)
    return pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "sums": pa.array([sums[a : a + SENT].tobytes() for a in at], pa.binary())})


def sums_read(sums: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The gradient and the Hessian of what sums_sent made."""
    hess = np.zeros((size, size))
    hess[np.triu_indices(size)] = sums[size:]
    hess += np.triu(hess, 1).T
    return sums[:size], hess


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0, most: int = MOST_LABELS, counterfactual: float = COUNTERFACTUAL, identity: Sequence[Sequence[str]] = IDENTITY) -> ToxicityModel | None:
    """Learns from the labelled documents outside the held-out fold; None if there are none.

    Each step of Newton's method sums the partitions' parts of the gradient and the Hessian, of fixed size: TASKS triangles of some
    4.5 MB reach the driver, in small rows and one partition at a time, however many partitions the rows came in.
    """
    rows = staged(training_rows(docs, labels, label, folds, fold, most), "toxic-training")
    n = rows.count()
    if not n:
        return None
    swap = swaps(identity)
    names = _vocabulary(rows, MOST_FEATURES, swap)
    where = {f: i for i, f in enumerate(names)}
    size = len(names) + 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in octets(batch.column("text"))]
            found = [sorted(where[f] for f in features_of(w, swap) if f in where) for w in words]
            other = [sorted(where[f] for f in features_of(swapped(w, swap), swap) if f in where) if not swap.keys().isdisjoint(w) else None for w in words]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, ints), pa.array(other, ints)], ["y", "x", "swap"])

    table_ = staged(rows.select("text", "y").mapInArrow(index, "y int, x array<int>, swap array<int>"), "toxic-features").coalesce(TASKS)

    def dense(lists: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(lists), size), np.float64)
        for i, x in enumerate(lists):
            out[i, x] = 1
        out[:, -1] = 1
        return out

    def step(weights: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grad, hess = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    b = batch.slice(at, 2000)
                    x, y, other = dense(b.column("x").to_pylist()), b.column("y").to_numpy(zero_copy_only=False), b.column("swap").to_pylist()
                    p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
                    grad += x.T @ (p - y)
                    hess += (x * (p * (1 - p))[:, None]).T @ x
                    mentions = [i for i, s in enumerate(other) if s is not None]
                    if mentions:
                        change = x[mentions] - dense([other[i] for i in mentions])
                        both = change.T @ change * counterfactual
                        grad += both @ weights
                        hess += both
            yield sums_sent(grad, hess)

        return run

    weights = np.zeros(size)
    ridge = PENALTY * np.ones(size)
    ridge[-1] = 1e-6
    for _ in range(STEPS):
        sums = np.zeros(size + size * (size + 1) // 2)
        for r in table_.mapInArrow(step(weights), "at long, sums binary").toLocalIterator(prefetchPartitions=True):
            part = np.frombuffer(r.sums)
            sums[r.at : r.at + len(part)] += part
        grad, hess = sums_read(sums, size)
        hess[np.diag_indices(size)] += ridge
        move = np.linalg.solve(hess, grad + ridge * weights)
        weights = weights - move
        if np.abs(move).max() < 1e-4:
            break
    return ToxicityModel(where, weights, swap, table_.filter("swap is not null").count())


def toxicity_score(model: ToxicityModel | None) -> Column:
    """The score of the column `text`; 0 without a model."""
    if model is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in octets(text)], pa.float64())

    return score(F.col("text"))


def classify_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, most: int = MOST_LABELS) -> DataFrame:
    """Returns doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, one row for each document.

    Only the words of the whole text are inputs. A null text scores as an empty one; a null doc_id is in the fold of
    the empty id; repeated rows score alike; no documents give no rows; without training labels every score is 0.
    Other columns are ignored.
    """
    score = toxicity_score(fit_toxicity(docs, labels, "toxic", folds, fold, most))
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select("doc_id", held_out(folds, fold).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
