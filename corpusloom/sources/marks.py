"""Which files a job is done with: a run takes the next few, and what it did is marked once it is done, so the next run goes on behind it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, job string"


class FileMarks:
    """Marks under `root`, by job: scanning, locating. A run adds one small file; a run that is lost before its mark is done again."""

    def __init__(self, spark: SparkSession, root: str, job: str):
        self.spark, self.root, self.job = spark, root.rstrip("/"), job

    def done(self) -> DataFrame:
        """path, each once. Nothing is done before the first mark."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/marks")
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], SCHEMA).select("path")
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.root}/marks").filter(F.col("job") == self.job).select("path").distinct()

    def due(self, files: DataFrame, limit: int | None = None) -> DataFrame:
        """The files (path, file_idx and more) that aren't done, the first `limit` of them in their order; 0 or None is all."""
        left = files.join(self.done(), "path", "left_anti")
        return left.orderBy("file_idx").limit(limit) if limit else left

    def mark(self, files: DataFrame) -> None:
        files.select("path", F.lit(self.job).alias("job")).coalesce(1).write.parquet(f"{self.root}/marks/{uuid.uuid4().hex}")

    def run(self, files: DataFrame, work: Callable[[DataFrame], None], limit: int | None = None) -> int:
        """Does the work on the files that are due, then marks them; returns how many. The work must bear being done again."""
        at = f"{self.root}/due/{uuid.uuid4().hex}"
        self.due(files, limit).coalesce(1).write.parquet(at)  # the same files for the work and for the mark
        some = self.spark.read.parquet(at)
        if n := some.count():
            work(some)
            self.mark(some)
        return n


def without_generation_counts(ledger: DataFrame) -> DataFrame:
    """The statistics ledger without what it has of generations, so that the next report counts them anew; counts of labels stay."""
    return ledger.filter(~F.coalesce(F.col("path").startswith("generations/"), F.lit(False)))
