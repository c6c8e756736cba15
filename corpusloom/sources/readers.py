"""The three input datasets as one relation of sentence positions, and the files they come from."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.identity import label_id, text_sha256
from corpusloom.schema import JOIN_KEYS


def guarded(status: Column, known: tuple[str, ...], where: Column) -> Column:
    """The status; an unknown or missing one ends the scan. Rows that a filter on the result drops are checked too."""
    bad = F.concat(F.lit("unknown status "), F.coalesce(status, F.lit("null")), F.lit(" at "), F.coalesce(where, F.lit("?")))
    return F.when(F.coalesce(status.isin(*known), F.lit(False)), status).otherwise(F.raise_error(bad).cast("string"))


def _texts(split: Column, sentences: Column, whole: Column, where: Column) -> Column:
    """The array to explode: the sentences of a split row, else its whole text. A split row without sentences is an error."""
    missing = F.raise_error(F.concat(F.lit("no sentences at "), F.coalesce(where, F.lit("?")))).cast("array<string>")
    return F.when(split, F.when(sentences.isNull(), missing).otherwise(sentences)).otherwise(F.array(whole))


def read_description(rows: DataFrame) -> DataFrame:
    """One row for each sentence of a split text, or one for the whole text of a language without segmentation."""
    where = F.concat_ws(":", "source_file", "description_identity")
    rows = rows.withColumn("status", guarded(F.col("split_status"), ("split", "unsupported_language", "not_detected"), where))
    split = F.col("status") == "split"
    keys = ["source_file", "description_identity", "tag_key"]
    out = rows.select(*keys, F.col("language_code").alias("language"), (~split).alias("unsplit"), F.posexplode(_texts(split, F.col("sentences"), F.col("original_text"), where)).alias("sentence_index", "text"))
    return out.select(F.lit("description").alias("dataset"), *keys, "sentence_index", "text", "language", "unsplit")


def read_wiki(rows: DataFrame) -> DataFrame:
    """One row for each input row."""
    status = guarded(F.col("segmentation_status"), ("split", "unsupported_language"), F.concat_ws(":", "source_file", "sentence_id"))
    return rows.select(F.lit("wiki").alias("dataset"), "source_file", "sentence_id", "text", "language", (status == "unsupported_language").alias("unsplit"))


def read_website(rows: DataFrame, fields: tuple[str, ...] = ("website", "contact_website")) -> DataFrame:
    """Unpivots the column groups of the fields; absent and empty texts give no rows."""
    group = lambda f: F.struct(F.lit(f).alias("field"), *[F.col(f"{f}_{c}").alias(n) for c, n in (("text", "whole"), ("language", "language"), ("sentences", "sentences"), ("sentence_status", "raw_status"))])
    rows = rows.select("source_file", "polygon_id", F.posexplode(F.array(*[group(f) for f in fields])).alias("field_position", "g")).select("source_file", "polygon_id", "field_position", "g.*")
    where = F.concat_ws(":", "source_file", "polygon_id", "field")
    rows = rows.withColumn("status", guarded(F.col("raw_status"), ("success", "unsupported_language", "absent", "empty_text"), where))
    rows = rows.filter(F.col("status").isin("success", "unsupported_language"))
    split = F.col("status") == "success"
    out = rows.select("source_file", "polygon_id", "field", "language", (~split).alias("unsplit"), F.posexplode(_texts(split, F.col("sentences"), F.col("whole"), where)).alias("sentence_index", "text"))
    return out.select(F.lit("website").alias("dataset"), "source_file", "polygon_id", "field", "sentence_index", "text", "language", "unsplit")


@dataclass(frozen=True)
class Source:
    name: str
    rank: int  # the first key of the order of work
    patterns: tuple[str, ...]
    read: Callable[[DataFrame], DataFrame]


SOURCES = {s.name: s for s in (Source("description", 0, ("*/data/*.parquet",), read_description), Source("wiki", 1, ("*/sentences/*.parquet",), read_wiki), Source("website", 2, ("*/data/*.parquet",), read_website))}


def with_identity(sentences: DataFrame, dataset: str) -> DataFrame:
    """Adds text_sha256 and label_id; a null text is an error."""
    text = F.when(F.col("text").isNull(), F.raise_error(F.lit("a sentence has no text")).cast("string")).otherwise(F.col("text"))
    return sentences.withColumn("text_sha256", text_sha256(text)).withColumn("label_id", label_id(F.col("dataset"), [k for k, _ in JOIN_KEYS[dataset]]))


def matching(pattern: str) -> str:
    """A regular expression for a file pattern in which * and ? also match slashes."""
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern) + "$"


def list_files(spark: SparkSession, root: str, patterns: tuple[str, ...]) -> DataFrame:
    """path (below root) and index: the files that match, in order. One row for each file is sorted."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("path"))
    relative = F.regexp_replace("path", f"^.*?{re.escape(root.split(':')[-1].rstrip('/'))}/", "")
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col("path").rlike(matching(p))
    named = files.select(relative.alias("path")).filter(hit)
    return named.withColumn("index", F.row_number().over(Window.orderBy("path")) - 1)


def read_files(spark: SparkSession, root: str, source: Source, columns: list[str] | None = None) -> DataFrame:
    """The rows of a source's files with source_file, through its reader."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(root)
    rows = rows.withColumn("source_file", F.regexp_replace(F.col("_metadata.file_path"), f"^.*?{re.escape(root.split(':')[-1].rstrip('/'))}/", ""))
    return source.read(rows.select(*columns, "source_file") if columns else rows)
