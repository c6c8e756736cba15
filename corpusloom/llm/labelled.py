"""The bounded sample of labelled documents that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._shared import id_crc, staged


def held_out(folds: int, fold: int):
    """True for the rows that a classifier must not learn from."""
    return id_crc(F.col("doc_id")) % folds == fold


def at_most(rows: DataFrame, number: Column, most: int) -> DataFrame:
    """The rows whose hash comes first, `most` at most and few less. A histogram of bounded size sets the limit; nothing is sorted."""
    n = rows.count()
    if n <= most:
        return rows
    place = F.pmod(number, F.lit(-(-4096 * n // most)))
    seen, cut = 0, 0
    for r in sorted(rows.filter(place < 4096).groupBy(place.alias("p")).count().collect()):
        if seen + r[1] > most:
            break
        seen, cut = seen + r[1], r[0] + 1
    return rows.filter(place < cut)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int) -> DataFrame:
    """doc_id, text, y: labelled documents outside the held-out fold, `most` labels at most.

    Labels are taken by a hash of their doc_id. As there are
    at most `most` of them, they are broadcast, and documents don't move. Rows without an id or a label don't count.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(folds, fold))
    sample = staged(at_most(known, F.xxhash64("doc_id"), most), "labels-sample")
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return text.join(F.broadcast(sample), "doc_id")
