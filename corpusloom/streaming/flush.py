"""Rows that come in small batches go out in large ones: by key, once there are enough, or once the first of them has waited long enough.

What waits is state, so it survives a restart. The sink writes what goes out as content-addressed parts in two phases and then notes the batch in a ledger: a batch that is run
again writes the same parts under the same names, and its note over the first one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, StructType

from corpusloom.sources.commit import ROWS, append_results

#: Rows of a key that go out together, and seconds that the first of them waits at most.
MOST_ROWS, MOST_SECONDS = 2048, 300.0


class Flush(StatefulProcessor):
    """Holds a key's rows until there are `rows` of them or the oldest is `seconds` old. Rows that go out together have one `flush`, counted from 1 by key."""

    def __init__(self, schema: StructType, rows: int, seconds: float | None):
        if rows < 1:
            raise ValueError("at least one row goes out at a time")
        self.columns, self.rows, self.seconds = schema, rows, seconds
        # pandas holds whole numbers with nulls as floats
        self.whole = [isinstance(f.dataType, IntegralType) for f in schema]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.columns)
        self.state = handle.getValueState("state", "held long, flushes long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held, flushes = self.state.get() or (0, 0)
        new, kept = pd.concat([frame[self.columns.names] for frame in rows], ignore_index=True), held
        if held + len(new) >= self.rows:
            # Whole flushes go out in one frame, whatever their number: what is held comes first and fills up the first of them.
            take = (held + len(new)) // self.rows * self.rows - held
            flushes, out = self._out(held, new.iloc[:take], flushes)
            yield out
            new, kept = new.iloc[take:], 0
            self._no_timers()
            self.waiting.clear()
        if len(new):
            self.waiting.appendList(self._values(new))
        self.state.update((kept + len(new), flushes))
        if kept + len(new) and self.seconds is not None and not list(self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + round(self.seconds * 1000))

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        held, flushes = self.state.get() or (0, 0)
        if held:
            flushes, out = self._out(held, None, flushes)
            yield out
            self.waiting.clear()
            self.state.update((0, flushes))

    def close(self) -> None:
        pass

    def _no_timers(self) -> None:
        for timer in list(self.handle.listTimers()) if self.seconds is not None else ():
            self.handle.deleteTimer(timer)

    def _values(self, rows: pd.DataFrame) -> list[tuple]:
        """Rows for the state, which knows no NaN: fewer than a flush has."""
        value = lambda v, whole: None if pd.isna(v) else int(v) if whole else v
        return [tuple(map(value, r, self.whole)) for r in rows.itertuples(index=False, name=None)]

    def _out(self, held: int, new: pd.DataFrame | None, flushes: int) -> tuple[int, pd.DataFrame]:
        """The number of flushes so far, and what is held, then the new rows, numbered in flushes of `rows`."""
        before = pd.DataFrame([tuple(r) for r in self.waiting.get()], columns=self.columns.names, dtype=object) if held else None
        rows = [x for x in (before, new) if x is not None]
        rows = pd.concat([x.astype(object) for x in rows], ignore_index=True) if len(rows) > 1 else rows[0]
        number = np.arange(len(rows)) // self.rows + flushes + 1
        return int(number[-1]), rows.assign(flush=number)


def flushed(stream: DataFrame, keys: list[str], rows: int = MOST_ROWS, seconds: float | None = MOST_SECONDS) -> DataFrame:
    """The rows of a stream, with `flush`, once they go out; for append mode. The session needs progress.ROCKSDB.

    Timers are for a query that goes on: one that takes what is available never ends while there may be timers, so for it `seconds` must be None, and rows go out by
    count only. A key holds fewer than `rows` rows of state; what is neither full nor old when a query stops waits for the next one."""
    schema = stream.schema
    out = StructType([*schema.fields]).add("flush", "long")
    return stream.groupBy(*keys).transformWithStateInPandas(Flush(schema, rows, seconds), out, "Append", "None" if seconds is None else "ProcessingTime")


def parts_sink(root: str, ledger: str, rows: int = ROWS) -> Callable[[DataFrame, int], None]:
    """A sink for rows with config_fingerprint, chunk_id and text_sha256: parts and manifests first, then the ledger's note of the batch (batch, n_parts, n_rows, chunks)."""

    def sink(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        parts = append_results(batch, root, rows)
        note = batch.agg(F.lit(number).cast("long").alias("batch"), F.lit(parts).cast("long").alias("n_parts"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct("chunk_id").alias("chunks"))
        note.coalesce(1).write.mode("overwrite").json(f"{ledger.rstrip('/')}/batch={number:09d}")

    return sink


def read_notes(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema("batch long, n_parts long, n_rows long, chunks long").option("recursiveFileLookup", "true").json(ledger)
