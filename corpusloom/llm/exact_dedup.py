"""Exact dedup with counting quotient filters (after Pandey, Bender, Johnson and Patro, 2017).

Each partition builds a filter of its texts' fingerprints. A filter keeps, for each quotient (the leading
bits), the sorted remainders (the other bits) and their counts, so two filters merge by merging sorted
remainders, and nothing is lost. Filters are cut into blocks of quotients; each block is merged in one task.
Fingerprints whose merged count is above one send their documents to byte verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import lowered, staged, table

#: Bits of a fingerprint that are the quotient; the block number is their leading part.
QUOTIENT_BITS = 24


def filter_of(prints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, which is by quotient and then remainder, with their counts."""
    keys, where = np.unique(prints, return_inverse=True)
    return keys, np.bincount(where, counts, len(keys)).astype(np.uint64)


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A filter block: run lengths of the quotients that occur, remainders, counts of 1 elided."""
    rest = np.uint64(64 - QUOTIENT_BITS)
    quotients, runs = np.unique(keys >> rest, return_counts=True)
    remainders = keys & np.uint64((1 << (64 - QUOTIENT_BITS)) - 1)
    many = np.flatnonzero(counts > 1)
    head = np.array([len(quotients), len(keys), len(many)], np.uint64)
    low = remainders.view(np.uint8).reshape(-1, 8)[:, : (64 - QUOTIENT_BITS + 7) // 8]
    return b"".join(x.tobytes() for x in (head, quotients.astype(np.uint32), runs.astype(np.uint32), many.astype(np.uint32), counts[many], low))


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints and counts of a block: exactly what packed() was given."""
    nq, n, nm = (int(x) for x in np.frombuffer(block, np.uint64, 3))
    at, width = 24, (64 - QUOTIENT_BITS + 7) // 8
    parts = []
    for kind, size in ((np.uint32, nq), (np.uint32, nq), (np.uint32, nm), (np.uint64, nm), (np.uint8, n * width)):
        parts.append(np.frombuffer(block, kind, size, at))
        at += parts[-1].nbytes
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :width] = parts[4].reshape(n, width)
    counts = np.ones(n, np.uint64)
    counts[parts[2]] = parts[3]
    return (np.repeat(parts[0].astype(np.uint64), parts[1]) << np.uint64(64 - QUOTIENT_BITS)) | remainders.view(np.uint64).reshape(-1), counts


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return filter_of(np.concatenate([k for k, _ in filters]), np.concatenate([c for _, c in filters]))


def _local_filters(block_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, n = None, [], 0
        for batch in batches:
            waiting.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(waiting[-1])
            if n >= 1 << 20:
                new = filter_of(np.concatenate(waiting))
                held, waiting, n = (merged([held, new]) if held else new), [], 0
        if n:
            new = filter_of(np.concatenate(waiting))
            held = merged([held, new]) if held else new
        if held is None:
            return
        keys, counts = held
        block = (keys >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(keys), np.int64)
        ids, starts = np.unique(block, return_index=True)
        ends = [*starts[1:], len(keys)]
        yield pa.RecordBatch.from_pydict({"block": pa.array(ids, pa.int64()), "filter": pa.array([packed(keys[a:b], counts[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary())})

    return build


def _repeated(group: pa.Table) -> pa.Table:
    keys, counts = merged([unpacked(x) for x in group.column("filter").to_pylist()])
    again = counts > 1
    return pa.table({"fp": pa.array(keys[again].view(np.int64)), "copies": pa.array(counts[again].astype(np.int64))})


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """fp, copies: the fingerprints that occur more than once in the long column `fp`."""
    bits = 0
    while rows >> (17 + bits) and bits < QUOTIENT_BITS:  # about 2**17 rows a block
        bits += 1
    local = prints.select("fp").mapInArrow(_local_filters(bits), "block long, filter binary")
    return local.groupBy("block").applyInArrow(_repeated, "fp long, copies long")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Returns doc_id, keep_id, group_size, kept, text_sha256, one row for each document.

    Texts are equal when identical after lower-casing A to Z. Of equal texts the row with the largest doc_id
    stays. A null text counts as empty; a null doc_id stays only if its whole group has none (and then the whole
    group does); rows that repeat a doc_id and a text count each in group_size and get the same answer; an empty table gives an empty
    result; other columns are ignored.
    """
    text = lowered(F.col("text"))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("norm"))
    slim = staged(base.select("doc_id", F.xxhash64("norm").alias("fp"), F.sha2("norm", 256).alias("text_sha256")), "dedup-prints")
    suspects = staged(repeated_fingerprints(slim, slim.count()), "dedup-suspects")  # of known size to the planner
    # Byte verification: the whole normalised texts are the grouping key. Copies meet in their own partition first.
    routed = base.withColumn("fp", F.xxhash64("norm")).join(suspects.select("fp"), "fp", "left_semi")
    same = routed.groupBy("fp", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    same = same.filter("group_size > 1").select("fp", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    same = staged(same, "dedup-classes")
    # The few documents of a class carry its key; all others meet nothing and stay.
    found = slim.join(same, ["fp", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = {
    "op4_exact_dedup": """
WITH norm AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
classes AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
SELECT n.doc_id, c.keep_id, c.group_size, n.doc_id IS NOT DISTINCT FROM c.keep_id AS kept, sha256(n.t) AS text_sha256
FROM norm n JOIN classes c ON n.t = c.t"""
}
