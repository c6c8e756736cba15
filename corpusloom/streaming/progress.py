"""Progress of chunks from manifests, with state for open chunks only: once a chunk is complete, its texts and parts are let go."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: State that is read and written by key, and can be larger than memory.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
PROGRESS = "chunk_id string, done long, parts long, complete boolean"


class ChunkProgress(StatefulProcessor):
    """Counts the distinct texts of a chunk until they are as many as planned. A chunk holds a few thousand texts by its plan, so that its state is read at once, once a batch.

    A complete chunk keeps one row, its totals: parts that come later change nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.texts = handle.getListState("texts", "text_sha256 string")
        self.parts = handle.getListState("parts", "part_id string")
        self.total = handle.getValueState("total", "done long, parts long, complete boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        last = self.total.get()
        if last is not None and last[2]:
            return
        texts, parts = {t for (t,) in self.texts.get()}, {p for (p,) in self.parts.get()}
        new_texts: dict[str, None] = {}
        new_parts: dict[str, None] = {}
        size = None
        for frame in rows:
            size = frame["size"].iloc[0] if size is None or pd.isna(size) else size
            new_texts |= dict.fromkeys(frame["text_sha256"][frame["text_sha256"].notna()])
            new_parts |= dict.fromkeys(frame["part_id"][frame["part_id"].notna()])
        new_texts = {t: None for t in new_texts if t not in texts}
        new_parts = {p: None for p in new_parts if p not in parts}
        done, seen = len(texts) + len(new_texts), len(parts) + len(new_parts)
        complete = size is not None and not pd.isna(size) and done >= int(size)
        if complete:
            self.texts.clear()
            self.parts.clear()
        else:
            if new_texts:
                self.texts.appendList([(t,) for t in new_texts])
            if new_parts:
                self.parts.appendList([(p,) for p in new_parts])
        if (done, seen, complete) != last:
            self.total.update((done, seen, complete))
            yield pd.DataFrame({"chunk_id": [key[0]], "done": [done], "parts": [seen], "complete": [complete]})

    def close(self) -> None:
        pass


def chunk_progress(manifests: DataFrame, lines: DataFrame) -> DataFrame:
    """chunk_id, done, parts, complete whenever they change, for update mode. manifests: a stream of chunk_id, part_id, text_sha256; lines: chunk_id and size of the
    planned chunks. A chunk without a line stays open. The session needs ROCKSDB."""
    sized = manifests.join(lines.select("chunk_id", "size"), "chunk_id", "left")
    return sized.groupBy("chunk_id").transformWithStateInPandas(ChunkProgress(), PROGRESS, "Update", "None")


def held(spark: SparkSession, checkpoint: str, state: str = "texts") -> DataFrame:
    """chunk_id, held: the rows of state that a stopped query keeps for each open chunk."""
    rows = spark.read.format("statestore").option("stateVarName", state).load(checkpoint)
    return rows.groupBy(F.col("key.chunk_id").alias("chunk_id")).agg(F.count(F.lit(1)).alias("held"))
