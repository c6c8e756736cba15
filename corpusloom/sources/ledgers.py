"""Append-only JSON-lines ledgers, JSON directories, benchmark files."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CorruptLedger(ValueError):
    """A terminated line of a ledger isn't JSON."""


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a ledger with seq, their place in it.

    The last line may be torn if it lacks its line feed, and is then left out; any other bad line is an error
    when it is read. A ledger is a file of one writer, so it is one split.
    """
    text = spark.read.text(path, wholetext=True).select(F.split("value", "\n").alias("lines"))
    lines = text.select(F.posexplode("lines").alias("seq", "line"), F.size("lines").alias("n")).filter(F.trim("line") != "")
    parsed = lines.withColumn("row", F.from_json("line", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    torn = F.col("seq") == F.col("n") - 1
    kept = parsed.filter(F.col("row._bad").isNull() | ~torn)
    bad = F.raise_error(F.concat(F.lit("corrupt ledger line "), (F.col("seq") + 1).cast("string"))).cast("bigint")
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    return kept.select(F.when(F.col("row._bad").isNull(), F.col("seq").cast("bigint")).otherwise(bad).alias("seq"), *[F.col(f"row.{n}").alias(n) for n in names])


def append_ledger(path: str, rows: Iterable[dict]) -> None:
    """Appends rows and makes them durable. A torn last line goes, a whole one without line feed gets it. Driver-side."""
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    data = file.read_bytes() if file.exists() else b""
    if data and not data.endswith(b"\n"):
        whole, _, last = data.rpartition(b"\n")
        try:
            json.loads(last)
            data += b"\n"
        except ValueError:
            data = whole + b"\n" if whole else b""
        write_atomic(path, data)
    with file.open("ab") as out:
        for row in rows:
            out.write(json.dumps(row, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode() + b"\n")
        out.flush()
        os.fsync(out.fileno())


def write_atomic(path: str, data: bytes) -> None:
    """The old bytes or the new ones, never a part. Driver-side."""
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    temporary = file.with_name(f".{file.name}.{os.getpid()}.tmp")
    with temporary.open("wb") as out:
        out.write(data)
        out.flush()
        os.fsync(out.fileno())
    temporary.replace(file)


def last_wins(ledger: DataFrame, key: str) -> DataFrame:
    """The last row of each key, with `first_seq`, the place of its first: sort by it for first-seen order."""
    names = [c for c in ledger.columns if c != key]
    kept = ledger.groupBy(key).agg(F.max_by(F.struct(*names), "seq").alias("row"), F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("versions"))
    return kept.select(key, *[F.col(f"row.{n}").alias(n) for n in names], "first_seq", "versions")


def needs_compaction(rows: int, keys: int) -> bool:
    return rows > 2 * keys + 100


def read_json_files(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """A row for each file, with its path; missing fields are null."""
    return spark.read.schema(schema).option("multiLine", "true").json(glob).withColumn("path", F.col("_metadata.file_path"))


def read_items(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(f"{root}/data/train.csv")
    return rows.select("item_id", "language", "sentence", "label")


def read_reference(spark: SparkSession, root: str, suffix: str = "*.json") -> DataFrame:
    """The predictions of each language's file; the language is the folder's name."""
    prediction = "item_id string, expected string, predicted string, generated_tokens int, truncated boolean, raw_output string"
    rows = spark.read.schema(f"predictions array<struct<{prediction.replace(' ', ': ').replace(',:', ',')}>>").option("multiLine", "true").json(f"{root}/*/{suffix}")
    rows = rows.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1).alias("language"), F.explode("predictions").alias("p"))
    return rows.select("language", "p.*")


def clusters(inventory: DataFrame) -> DataFrame:
    """One row for each cluster: its first node with a GPU stands for it."""
    gpu = inventory.filter("gpu is not null")
    return gpu.groupBy("site", "cluster").agg(F.min_by(F.struct("gpu", "vendor", "memory_mib", "compute_capability", "gpus_per_node", "queues", "exotic", "arch"), "node").alias("first"), F.count(F.lit(1)).alias("nodes")).select("site", "cluster", "first.*", "nodes")
