"""Language-model scoring with a subword lattice.

The vocabulary and its scores exist, and all its pieces are used. The scores weight all segmentations of the corpus's words; two passes then
re-estimate each piece's probability in each language class from its expected uses in the training documents, with the scores as a small prior.
A word's probability is the marginal over its lattice: every segmentation, and, for a word seen in training, one edge
over the whole word (Witten and Bell's share of the mass for each). A text is a mixture over the classes, so
its probability, too, is a marginal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import id_crc, octets, staged, table, wide
from corpusloom.llm.lattice import Lattice, read_vocabulary

FOLDS, FOLD = 5, 1
#: Language classes, and frequent words whose statistics every task has at hand, at most. Others are joined.
MOST_CLASSES, HEAD = 8, 200_000
#: Passes over the words' counts that set the pieces' probabilities; weight of the vocabulary's own scores, in uses a piece.
PASSES, PRIOR = 2, 0.05


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


@dataclass(frozen=True)
class LatticeModel:
    """classes: language names, with None for null; the last may stand for all others."""

    plain: Lattice  # with the vocabulary's own scores
    lattice: Lattice
    documents: np.ndarray  # in training, by class
    tokens: np.ndarray  # with ends, by class
    types: np.ndarray
    base_total: int
    base_types: int

    def log10_words(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 of each word's probability in each class. counts: its uses in training, by class."""
        lattice = np.exp(self.lattice.likelihoods(words))
        return np.log10(np.maximum((counts + self.types * lattice) / (self.tokens + self.types), 1e-300))

    def log10_plain(self, words: list[bytes]) -> np.ndarray:
        """log10 of each word's marginal probability under the vocabulary's own scores alone."""
        return self.plain.likelihoods(words)[:, 0] / np.log(10)

    def log10_ends(self) -> np.ndarray:
        """log10 of the class's share and of its probability of an end."""
        share = np.log10(np.maximum(self.documents, 0.5) / max(self.documents.sum(), 1.0))
        return share + np.log10(np.maximum(self.documents, 0.5) / (self.tokens + self.types))

    def base_offset(self) -> float:
        return float(np.log10(self.base_total + 0.5 * (self.base_types + 1)))


def _class_of(docs: DataFrame, training: Column) -> tuple[Column, np.ndarray]:
    """The number of a document's class, and the training documents of each."""
    seen = docs.filter(training).groupBy("lang").count().orderBy(F.desc("count"), F.col("lang").asc_nulls_last()).limit(MOST_CLASSES).collect()
    total = docs.filter(training).count()
    names = seen[: MOST_CLASSES - 1]
    number = F.lit(len(names))
    for i, r in enumerate(names):
        number = F.when(F.col("lang").eqNullSafe(F.lit(r[0])), F.lit(i)).otherwise(number)
    sizes = [float(r["count"]) for r in names]
    rest = total - sum(sizes)
    if rest > 0 or not names:
        sizes.append(rest)
    else:
        number = F.least(number, F.lit(len(names) - 1))  # documents of no class count nowhere in training
    return number, np.array(sizes)


def _word_counts(docs: DataFrame, training: Column, number: Column, classes: int) -> DataFrame:
    """word, c0, c1, ...: uses in the training documents of each class; words of other documents have zeros."""
    names = [f"c{k}" for k in range(classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter[bytes]] = [Counter() for _ in range(classes)]

        def out() -> pa.RecordBatch:
            words = list(set().union(*held))
            return pa.RecordBatch.from_arrays([_binary(words), *[pa.array([c[w] for w in words], pa.int64()) for c in held]], ["word", *names])

        for batch in batches:
            for text, k in zip(octets(batch.column("text")), batch.column("k").to_pylist(), strict=True):
                held[k].update(text.lower().split())
            if sum(map(len, held)) > 400_000:
                yield out()
                held = [Counter() for _ in range(classes)]
        yield out()

    known = docs.filter(training).select("text", number.alias("k"))
    return known.mapInArrow(run, "word binary, " + ", ".join(f"{c} long" for c in names)).groupBy("word").agg(*[F.sum(c).alias(c) for c in names])


def fit_lattice(docs: DataFrame, vocabulary: str | None = None, folds: int = FOLDS, fold: int = FOLD) -> tuple[LatticeModel, DataFrame]:
    """The model, and the counts of all training words (word, c0, c1, ...)."""
    weights = read_vocabulary(vocabulary or default_vocabulary())
    pieces = list(weights)
    prior = np.array([weights[p] for p in pieces])
    prior /= prior.sum()
    training = id_crc(F.col("doc_id")) % folds != fold
    number, documents = _class_of(docs, training)
    classes = len(documents)
    columns = [f"c{k}" for k in range(classes)]
    counts = staged(_word_counts(docs, training, number, classes), "lm-counts")
    row = counts.agg(F.count(F.lit(1)), *[F.sum(c) for c in columns], *[F.count_if(F.col(c) > 0) for c in columns]).first()
    uses = np.array([float(x or 0) for x in row[1 : 1 + classes]])
    types = np.maximum(np.array([float(x or 0) for x in row[1 + classes :]]), 1.0)
    lattice = plain = Lattice.of(pieces, np.log(prior))
    spread = counts.repartition(wide(counts))
    for _ in range(PASSES):
        expected = np.zeros((classes, len(pieces)))
        for r in _expected_uses(spread, lattice, classes).collect():  # a row for each piece
            expected[:, r.piece] = [r[f"e{k}"] for k in range(classes)]
        extra = PRIOR * len(pieces)
        lattice = lattice.with_logp(np.log((expected + extra * prior) / (expected.sum(1) + documents + extra)[:, None]).T)
    some = int(documents.sum() > 0)
    model = LatticeModel(plain, lattice, documents, uses + np.maximum(documents, 0.5), types, int(uses.sum() + documents.sum()), int(row[0]) + some)
    return model, counts


def _matrix(batch: pa.RecordBatch, classes: int) -> np.ndarray:
    return np.stack([np.asarray(batch.column(f"c{k}").fill_null(0)).astype(np.float64) for k in range(classes)], axis=1)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 60_000) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=n)[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=n)[0]


def _expected_uses(counts: DataFrame, lattice: Lattice, classes: int) -> DataFrame:
    """piece, e0, e1, ...: the expected uses of each piece in the counted words."""
    names = [f"e{k}" for k in range(classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = np.zeros((classes, len(lattice.pieces)))
        for batch in _gathered(batches):
            lattice.likelihoods(batch.column("word").to_pylist(), _matrix(batch, classes), expected)
        used = np.flatnonzero(expected.sum(0) > 0)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *[pa.array(e[used]) for e in expected]], ["piece", *names])

    return counts.mapInArrow(run, "piece int, " + ", ".join(f"{e} double" for e in names)).groupBy("piece").agg(*[F.sum(e).alias(e) for e in names])


def _scored_words(words: DataFrame, model: LatticeModel, keep: str, kind: str, times: str | None) -> DataFrame:
    """For rows of a word and its counts: `keep`, s0, s1, ... (log10 by class), base, plain, known, each times the column `times`."""
    classes = len(model.documents)
    names = [*(f"s{k}" for k in range(classes)), "base", "plain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            distinct, where = np.unique(np.array(batch.column("word").to_pylist(), object), return_inverse=True)
            counts = np.zeros((len(distinct), classes))
            counts[where] = _matrix(batch, classes)  # the same for all rows of a word
            total = counts.sum(1)
            words_ = distinct.tolist()
            found = np.hstack([model.log10_words(words_, counts), np.log10(total + 0.5)[:, None], model.log10_plain(words_)[:, None], (total > 0)[:, None]])[where]
            if times:
                found = found * np.asarray(batch.column(times)).astype(np.float64)[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(keep), *[pa.array(found[:, k]) for k in range(classes + 2)], pa.array(found[:, -1].astype(np.int64))], [keep, *names, "known"])

    return words.mapInArrow(run, f"{keep} {kind}, " + ", ".join(f"{n} double" for n in names) + ", known long")


def _most_frequent(counts: DataFrame, total: Column, most: int) -> DataFrame:
    """The words of the largest counts, `most` at most: a histogram of the counts' logarithms, of bounded size, sets the limit and nothing is sorted."""
    grade = F.floor(F.log2(F.greatest(total, F.lit(1)).cast("double")) * 16).cast("int")
    seen, least = 0, None
    for r in sorted(counts.groupBy(grade.alias("grade")).count().collect(), reverse=True):
        if seen + r[1] > most:
            break
        seen, least = seen + r[1], r[0]
    return counts.filter(F.lit(False) if least is None else grade >= least)


def score_documents(docs: DataFrame, vocabulary: str | None = None, folds: int = FOLDS, fold: int = FOLD, head: int = HEAD) -> DataFrame:
    """Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score, one row for each document.

    Words are runs without ASCII white space, A to Z lower-cased; an end follows the last. base_score is the add-half unigram
    of whole words, score the lattice model's log10 probability, lattice_score the log10 marginal of the words over all
    segmentations under the vocabulary's own scores, without anything learned (and without an end). Null and empty texts are an end alone; a null doc_id counts as the
    empty id; repeated rows are learned from and scored each; a null lang is a class of its own in training and plays no
    part in scoring; no documents give no rows; without training documents the vocabulary's own
    scores and an end of probability 1/3 are the model. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    model, counts = fit_lattice(docs, vocabulary, folds, fold)
    classes = len(model.documents)
    columns = [f"c{k}" for k in range(classes)]
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    frequent = _most_frequent(counts, total, head)
    frequent = _scored_words(frequent.repartition(wide(counts)), model, "word", "binary", None).collect()
    index = {bytes(r.word): i for i, r in enumerate(frequent)}
    values = np.array([tuple(r)[1:] for r in frequent], np.float64).reshape(len(frequent), classes + 3)
    shared = spark.sparkContext.broadcast((index, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, values = shared.value
        for batch in batches:
            n, sums, tails, uses = [], [], [], []
            for text in octets(batch.column("text")):
                words = text.lower().split()
                at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                rare = Counter(words[i] for i in np.flatnonzero(at < 0).tolist())
                n.append(len(words) + 1)
                sums.append(values[at[at >= 0]].sum(0))
                tails.append(list(rare))
                uses.append(list(rare.values()))
            arrays = [pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.float64())), pa.array(tails, pa.list_(pa.binary())), pa.array(uses, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), batch.column("held_out"), *arrays], ["key", "doc_id", "held_out", "n_tokens", "sums", "tail", "uses"])

    schema = "key long, doc_id long, held_out boolean, n_tokens long, sums array<double>, tail array<binary>, uses array<int>"
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", (id_crc(F.col("doc_id")) % folds == fold).alias("held_out"), "text")
    parts = staged(keyed.mapInArrow(run, schema), "lm-parts")  # the table fixes the keys
    rare = parts.select("key", F.explode(F.arrays_zip("tail", "uses")).alias("x")).select("key", F.col("x.tail").alias("word"), F.col("x.uses").alias("uses"))
    rare = rare.join(counts, "word", "left")
    sums = _scored_words(rare.select("key", "word", "uses", *columns), model, "key", "long", "uses")
    names = [*(f"s{k}" for k in range(classes)), "base", "plain", "known"]
    sums = sums.groupBy("key").agg(*[F.sum(n).alias(n) for n in names])
    ends = model.log10_ends()
    some = int(model.documents.sum() > 0)
    both = parts.drop("tail", "uses").join(sums, "key", "left")
    part = lambda k: F.get("sums", F.lit(k)) + F.coalesce(F.col(names[k]), F.lit(0.0))
    by_class = F.array(*[part(k) + F.lit(float(ends[k])) for k in range(classes)])
    top = F.array_max(by_class)
    score = top + F.log10(F.aggregate(by_class, F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - top)))
    end_base = float(np.log10(model.documents.sum() + 0.5))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.get("sums", F.lit(classes + 2)) + F.coalesce("known", F.lit(0)) + F.lit(some)).cast("bigint").alias("n_known"),
        F.lit(model.base_total).cast("bigint").alias("train_tokens"),
        (part(classes) + F.lit(end_base) - F.col("n_tokens") * F.lit(model.base_offset())).alias("base_score"),
        score.alias("score"),
        part(classes + 1).alias("lattice_score"),
    )


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
