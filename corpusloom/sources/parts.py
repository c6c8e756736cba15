"""Content-addressed result parts and their manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.identity import last_components
from corpusloom.schema import PROVENANCE
from corpusloom.sources.commit import append_results
from corpusloom.sources.part_scan import scan_parts

__all__ = ["append_results", "corrupt_parts", "manifest", "manifest_rows", "quarantine", "read_chunk", "read_manifests", "read_valid_parts", "scan_parts", "stamped", "verified_paths", "write_chunks"]


def verified_paths(spark: SparkSession, root: str) -> DataFrame:
    """path, key (last three components), valid: whether a part's bytes hash to its name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    stem = F.regexp_extract("path", "([^/]+)\\.parquet$", 1)
    return files.select("path", last_components(F.col("path")).alias("key"), (F.sha2("content", 256) == stem).alias("valid"))


def read_valid_parts(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of the parts whose bytes are whole, with part_key and row_index; each part is read once."""
    return scan_parts(spark, root, schema).filter("not corrupt").drop("corrupt")


def corrupt_parts(spark: SparkSession, root: str) -> DataFrame:
    """part_key of the parts whose bytes don't hash to their name."""
    return scan_parts(spark, root, "text_sha256 string").filter("corrupt").select("part_key")


def stamped(results: DataFrame, provenance: dict[str, str]) -> DataFrame:
    """Rows with what they say of their run; a missing name is an error."""
    missing = [n for n in PROVENANCE if n not in provenance]
    if missing:
        raise KeyError(f"no {', '.join(missing)}")
    return results.withColumns({n: F.lit(provenance[n]) for n in PROVENANCE})


def write_chunks(chunks: DataFrame, path: str) -> None:
    """One folder for each chunk, rows by (prompt_tokens, text_sha256)."""
    ordered = chunks.repartition("chunk_id").sortWithinPartitions("chunk_id", "prompt_tokens", "text_sha256")
    ordered.write.mode("append").option("compression", "zstd").partitionBy("chunk_id").parquet(path)


def read_chunk(spark: SparkSession, path: str, chunk: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("chunk_id") == chunk)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file into place, and drops it if one of that name is there: names tell the content."""
    fs, there = _file_system(spark, target)
    _, here = _file_system(spark, source)
    fs.mkdirs(there.getParent())
    if fs.exists(there):
        fs.delete(here, False)
    elif not fs.rename(here, there):
        raise OSError(f"can't rename {source} to {target}")


def quarantine(spark: SparkSession, root: str, to: str) -> list[str]:
    """Moves parts whose bytes don't hash to their name out of the way; returns their keys. Damaged parts are taken to be few."""
    bad = sorted(r.part_key for r in corrupt_parts(spark, root).collect())
    for key in bad:
        _move(spark, f"{root.rstrip('/')}/{key}", f"{to.rstrip('/')}/{key}")
    return bad


def manifest(part: DataFrame) -> DataFrame:
    """part_id and its sorted hashes."""
    return part.groupBy("part_id").agg(F.sort_array(F.collect_set("text_sha256")).alias("text_sha256s"))


def read_manifests(spark: SparkSession, glob: str) -> DataFrame:
    """chunk_id, part_id, text_sha256 of the readable manifests; malformed ones are left out, to be fetched again."""
    text = spark.read.text(glob, wholetext=True).select("value", last_components(F.col("_metadata.file_path")).alias("key"))
    return manifest_rows(text, F.col("value"))


def manifest_rows(text: DataFrame, value: Column) -> DataFrame:
    parsed = text.withColumn("m", F.from_json(value, "part_id string, text_sha256s array<string>"))
    whole = parsed.filter(F.col("m.text_sha256s").isNotNull())
    return whole.select(F.regexp_extract("key", "([^/]+)/[^/]+$", 1).alias("chunk_id"), F.col("m.part_id").alias("part_id"), F.explode("m.text_sha256s").alias("text_sha256"))
