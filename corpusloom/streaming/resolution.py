"""The verdict of each text so far, kept as sorted levels of runs: catching up reads what is new, and reading the whole reads a few runs, not every batch.

A batch of verdicts becomes a run of level 0: one row a text, parted into buckets by the text's hash. Once a level has `fanout` runs, they are merged into
one of the next level, bucket by bucket. So after n batches there are at most (fanout - 1) runs on each of log(n) levels. The smallest part key wins, whenever a run
is merged, so it doesn't matter in which order parts come. A state file says which runs count and which batch was the last; it is written after the runs, under the next
number, so readers see either the old runs or the new ones, and a batch that is run again after it was counted adds nothing.

Everything stands under the version of the parser: verdicts of another version are void, and nothing of it is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.answers import PARSER_VERSION, parse_generation
from corpusloom.sources.commit import opened
from corpusloom.sources.states import keep_state, last_state
from corpusloom.streaming import ingest

VERDICTS = "text_sha256 string, decision string, parse_mode string, failure_reason string, part_key string, row_index long"


@dataclass
class Levels:
    """Which runs count: by level, oldest first. number: of this state; batch: the last that is in it."""

    number: int = 0
    batch: int = -1
    made: int = 0
    runs: list[list[str]] = field(default_factory=list)

    def names(self) -> list[str]:
        return [name for level in self.runs for name in level]


class ResolutionStore:
    """Verdicts under root/v<version>. One writer at a time; readers at any time."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, fanout: int = 4, version: int | str = PARSER_VERSION):
        if fanout < 2:
            raise ValueError("a merge takes two runs at least")
        self.spark, self.root, self.buckets, self.fanout = spark, f"{root.rstrip('/')}/v{version}", buckets, fanout

    def levels(self) -> Levels:
        """The last state that was written."""
        state = last_state(self.root)
        return Levels(**state) if state else Levels()

    def add(self, parts: DataFrame, batch: int) -> Levels:
        """Takes in rows of parts (text_sha256, raw_output, truncated, part_key, row_index), as batch number `batch`; a batch that is in already changes nothing."""
        state = self.levels()
        if batch <= state.batch:
            return state
        verdict = parse_generation(F.col("raw_output"), F.col("truncated"))
        rows = parts.select("text_sha256", verdict.alias("v"), "part_key", "row_index").select("text_sha256", "v.decision", "v.parse_mode", "v.failure_reason", "part_key", "row_index")
        bucket = F.pmod(F.xxhash64("text_sha256"), F.lit(self.buckets)).cast("int")
        runs = [list(level) for level in state.runs] or [[]]
        runs[0].append(self._write(rows.withColumn("bucket", bucket), state))
        level = 0
        while level < len(runs) and len(runs[level]) >= self.fanout:
            merged = self._write(self._read(runs[level]), state)
            if level + 1 == len(runs):
                runs.append([])
            runs[level + 1].append(merged)
            runs[level] = []
            level += 1
        state = Levels(state.number + 1, batch, state.made, runs)
        self._keep(state)
        return state

    def verdicts(self) -> DataFrame:
        """One row a text: text_sha256, decision, parse_mode, failure_reason, part_key, row_index."""
        names = self.levels().names()
        if not names:
            return self.spark.createDataFrame([], VERDICTS)
        return self._first(self._read(names)).drop("bucket")

    def sink(self) -> Callable[[DataFrame, int], None]:
        return lambda batch, number: self.add(batch, number) and None

    def _first(self, rows: DataFrame) -> DataFrame:
        """The row of the smallest part key, then row number, of each text."""
        kept = ("decision", "parse_mode", "failure_reason")
        best = F.min(F.struct("part_key", "row_index", *kept)).alias("b")
        return rows.groupBy("bucket", "text_sha256").agg(best).select("bucket", "text_sha256", *[f"b.{c}" for c in kept], "b.part_key", "b.row_index")

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(f"{VERDICTS}, bucket int").option("basePath", f"{self.root}/runs").parquet(*[f"{self.root}/runs/run={n}" for n in names])

    def _write(self, rows: DataFrame, state: Levels) -> str:
        """A new run. Its number isn't used again, even if this is broken off and done again under the same one: it is then overwritten."""
        state.made += 1
        name = f"{state.made:09d}"
        # A bucket grows with the store, so a large one is split over tasks and files; a small one is one file.
        first = self._first(rows).hint("rebalance", "bucket")
        first.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.root}/runs/run={name}")
        return name

    def _keep(self, state: Levels) -> None:
        """Writes the state, then forgets the state before the last and the runs that only older states name."""
        named = {n for kept in keep_state(self.root, state.number, asdict(state)) for n in Levels(**kept).names()}
        fs, base = opened(self.root)
        for x in fs.get_file_info(pafs.FileSelector(f"{base}/runs")):
            if x.base_name.removeprefix("run=") not in named:
                fs.delete_dir(x.path)


def catch_up(store: ResolutionStore, path: str, schema: str, checkpoint: str, files: int = ingest.FILES) -> DataFrame:
    """Takes in the parts under `path` that weren't seen, `files` at a time, and returns the verdicts. Stopped midway, it goes on from its last batch.

    The checkpoint belongs to the store: it has the parser's version in its name, too."""
    stream = ingest.part_stream(store.spark, path, schema, files)
    ingest.run_available(stream, f"{checkpoint.rstrip('/')}/{store.root.rsplit('/', 1)[-1]}", store.sink(), "append").awaitTermination()
    return store.verdicts()
