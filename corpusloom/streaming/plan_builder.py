"""A plan that grows: texts of new files are chunked behind those that are planned, and the last, partial chunk is held back until it is full or the plan is final.

An append numbers its new texts by file and hash and writes them behind all others. Emission takes the next few chunks from where it
stopped, so it can be stopped between two batches of chunks and go on later, and the texts that wait are never written again. As long as files come in their order, the
chunks are those that one plan over all files has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import planning
from corpusloom.sources.states import keep_state, last_state

#: Chunks that are emitted before it may stop.
EMIT_BATCH = 5


@dataclass
class Plan:
    number: int = 0
    #: The last append that is in, and by append: name, first ordinal, texts.
    batch: int = -1
    segments: list[tuple[str, int, int]] = field(default_factory=list)
    #: Texts and chunks that are emitted, and in how many batches.
    emitted: int = 0
    chunks: int = 0
    emissions: int = 0

    def rows(self) -> int:
        return sum(n for _, _, n in self.segments)


class PlanBuilder:
    """The plan under `root`. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, size: int, fingerprint: Column):
        if size < 1:
            raise ValueError("a chunk has at least one text")
        self.spark, self.root, self.size, self.fingerprint = spark, root.rstrip("/"), size, fingerprint

    def plan(self) -> Plan:
        state = last_state(self.root)
        return Plan(**state) if state else Plan()

    def append(self, texts: DataFrame, batch: int) -> Plan:
        """Takes in unique texts (text_sha256, file_idx and what the chunks are to hold) as append number `batch`; those that are known are left out, and an append that is in changes nothing."""
        plan = self.plan()
        if batch <= plan.batch:
            return plan
        if plan.segments:
            known = self._segments(plan).select("text_sha256")
            texts = texts.join(known, "text_sha256", "left_anti")
        name, first = f"{batch:09d}", plan.rows()
        placed = planning.file_ordinal(texts).withColumn("ordinal", F.col("ordinal").cast("bigint") + first)
        placed.repartitionByRange("ordinal").sortWithinPartitions("ordinal").write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/texts/{name}")
        n = self.spark.read.parquet(f"{self.root}/texts/{name}").count()
        return self._keep(plan, batch=batch, segments=[*plan.segments, (name, first, n)])

    def emit(self, final: bool = False, per: int = EMIT_BATCH, on_batch: Callable[[int], None] | None = None, should_stop: Callable[[], bool] | None = None) -> int:
        """Emits the chunks that are full, `per` at a time, and if it is final the last one, too; returns how many. on_batch gets the number so far; no batch starts once should_stop() is true.

        Where nobody watches or stops it, all go out in one write: each batch is a job that looks through its appends, so that many small ones cost more than the texts."""
        plan, before = self.plan(), self.plan().chunks
        while True:
            left = plan.rows() - plan.emitted
            n = -(-left // self.size) if final else left // self.size
            n = min(per, n) if on_batch or should_stop else n
            if not n or should_stop and should_stop():
                return plan.chunks - before
            until = min(plan.rows(), plan.emitted + n * self.size)
            some = [s for s in plan.segments if s[1] < until and s[1] + s[2] > plan.emitted]
            rows = self._segments(plan, some).filter((F.col("ordinal") >= plan.emitted) & (F.col("ordinal") < until))
            chunks = planning.chunked(rows.withColumn("ordinal", F.col("ordinal") - plan.emitted), self.size, self.fingerprint)
            chunks = chunks.withColumns({"group": F.col("group").cast("bigint") + plan.chunks, "ordinal": F.col("ordinal") + plan.emitted})
            chunks.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/chunks/{plan.emissions:09d}")
            plan = self._keep(plan, emitted=until, chunks=plan.chunks + n, emissions=plan.emissions + 1)
            if on_batch:
                on_batch(plan.chunks - before)

    def emitted(self) -> DataFrame | None:
        """The texts of the chunks so far, with ordinal, group and chunk_id; None if there are none."""
        plan = self.plan()
        paths = [f"{self.root}/chunks/{i:09d}" for i in range(plan.emissions)]
        return self.spark.read.parquet(*paths) if paths else None

    def waiting(self) -> int:
        """Texts that are in no chunk yet."""
        plan = self.plan()
        return plan.rows() - plan.emitted

    def sink(self, per: int = EMIT_BATCH) -> Callable[[DataFrame, int], None]:
        """For a stream of texts: each batch is an append, and what is full goes out."""

        def take(batch: DataFrame, number: int) -> None:
            self.append(batch, number)
            self.emit(per=per)

        return take

    def _segments(self, plan: Plan, some: list[tuple[str, int, int]] | None = None) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/texts/{name}" for name, _, _ in (plan.segments if some is None else some)])

    def _keep(self, plan: Plan, **changed: object) -> Plan:
        plan = Plan(**(asdict(plan) | changed | {"number": plan.number + 1}))
        keep_state(self.root, plan.number, asdict(plan))
        return plan
