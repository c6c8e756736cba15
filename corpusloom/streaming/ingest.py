"""Growing sets of parts and manifests as streams. A late part is never dropped: the smallest key wins whenever it comes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.answers import PARSER_VERSION, parse_generation
from corpusloom.functions.identity import last_components
from corpusloom.sources.parts import manifest_rows

#: A micro-batch is flushed after so many seconds; files in one at most.
INTERVAL, FILES = 300, 1000


def manifest_stream(spark: SparkSession, path: str, files: int = FILES) -> DataFrame:
    """chunk_id, part_id, text_sha256, each (chunk, text) once: the checkpoint knows what has been seen."""
    text = spark.readStream.format("text").schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files).load(path)
    rows = manifest_rows(text.select("value", last_components(F.col("_metadata.file_path")).alias("key")), F.col("value"))
    return rows.dropDuplicates(["chunk_id", "text_sha256"])


def part_stream(spark: SparkSession, path: str, schema: str, files: int = FILES) -> DataFrame:
    """Rows of parts as they come, with part_key and row_index."""
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).parquet(path)
    return rows.select("*", last_components(F.col("_metadata.file_path")).alias("part_key"), F.col("_metadata.row_index").alias("row_index"))


def verdict_stream(parts: DataFrame) -> DataFrame:
    """The verdict of each text so far, kept as state; for update mode. State is one row for each text, so use the RocksDB store."""
    v = parse_generation(F.col("raw_output"), F.col("truncated"))
    best = F.min(F.struct(F.col("part_key"), F.col("row_index"), v.alias("v")))
    return parts.groupBy("text_sha256").agg(best.alias("b")).select("text_sha256", "b.v.decision", "b.v.parse_mode", "b.v.failure_reason", "b.part_key")


def progress_stream(manifests: DataFrame) -> DataFrame:
    """Distinct texts with a result by chunk, from deduplicated rows; for update mode."""
    return manifests.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("done"))


def checkpoint_for(root: str, name: str) -> str:
    """Results parsed under another version of the rules are void, so each version has its own checkpoint."""
    return f"{root.rstrip('/')}/{name}-v{PARSER_VERSION}"


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "update") -> StreamingQuery:
    """Takes in what is there now, in bounded batches, and stops: one bounded pull."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()


def run_forever(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], seconds: int = INTERVAL, mode: str = "update") -> StreamingQuery:
    """The background worker: a bounded batch for each interval until stop() is called."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(processingTime=f"{seconds} seconds").start()


def versions_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink of versions: each batch is its own folder, written again if the batch is run again; latest() reads the last of each key."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch_{number:08d}")

    return sink


def latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    names = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), "batch").alias("r")).select(key, "r.*")


def completing(lines: DataFrame, done_path: str, register: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A sink that registers chunks whose distinct texts reach their planned size, each once."""

    def sink(batch: DataFrame, number: int) -> None:
        full = batch.join(lines.select("chunk_id", "size"), "chunk_id").filter("done >= size").select("chunk_id")
        full.write.mode("overwrite").parquet(f"{done_path}/batch_{number:08d}")
        register(batch.sparkSession.read.parquet(f"{done_path}/batch_{number:08d}"))

    return sink
