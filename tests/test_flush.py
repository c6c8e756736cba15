"""Flushes by count and by time, and a sink that may be run again."""

import os
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import parts
from corpusloom.streaming import flush, ingest, progress

SCHEMA = "text_sha256 string, raw_output string, prompt_tokens int, chunk_id string, config_fingerprint string"


@pytest.fixture
def rocks(spark):
    for k, v in progress.ROCKSDB.items():
        spark.conf.set(k, v)
    yield
    for k in progress.ROCKSDB:
        spark.conf.unset(k)


def rows(spark, path, first, counts):
    data = [(f"h{first + i:05}", None if i % 3 else f"out {i}", None if i % 5 == 0 else i, c, "fp") for c, n in counts.items() for i in range(n)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return data


def seen(spark, root):
    return sorted((tuple(r[:5]) for r in parts.read_valid_parts(spark, root, SCHEMA).collect()), key=str)


def test_full_flushes_go_out_and_the_rest_waits_over_restarts(spark, tmp_path, rocks):
    inp, out, ledger, check = (str(tmp_path / n) for n in ("in", "out", "ledger", "check"))
    sizes, lost = [], [True]

    def pull():
        stream = flush.flushed(spark.readStream.schema(SCHEMA).parquet(inp), ["chunk_id"], rows=10, seconds=None)
        sink = flush.parts_sink(out, ledger)

        def watched(batch, number):
            sizes.extend((r.chunk_id, r.flush, r["count"]) for r in batch.groupBy("chunk_id", "flush").count().collect())
            sink(batch, number)
            if lost.pop() if lost else False:
                raise RuntimeError("lost")  # after the sink has written all

        ingest.run_available(stream, check, watched, "append").awaitTermination(120)

    data = rows(spark, inp, 0, {"a": 23, "b": 4})
    with pytest.raises(Exception, match="lost"):
        pull()
    first = {str(p) for p in (tmp_path / "out").glob("*/*/*.parquet")}
    sizes.clear()
    pull()
    assert sorted(sizes) == [("a", 1, 10), ("a", 2, 10)] and len(seen(spark, out)) == 20  # 3 of a and 4 of b wait
    assert {str(p) for p in (tmp_path / "out").glob("*/*/*.parquet")} == first  # the batch that was run again wrote nothing twice
    data += rows(spark, inp, 100, {"a": 7, "b": 5})
    pull()
    assert sorted(sizes)[2:] == [("a", 3, 10)]
    got = seen(spark, out)
    assert len(got) == 30 and set(got) == {r for r in data if r[3] == "a"}
    notes = flush.read_notes(spark, ledger).orderBy("batch").collect()
    assert [(r.n_rows, r.chunks) for r in notes] == [(20, 1), (10, 1)] and len({r.batch for r in notes}) == 2


def test_old_rows_go_out_by_the_clock(spark, tmp_path, rocks):
    inp, out, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    rows(spark, inp, 0, {"a": 3, "b": 12})
    stream = flush.flushed(spark.readStream.schema(SCHEMA).parquet(inp), ["chunk_id"], rows=10, seconds=2)

    def noted():
        done = os.path.exists(ledger) and any(n.startswith("batch=") for n in os.listdir(ledger))
        return flush.read_notes(spark, ledger).agg(F.sum("n_rows")).first()[0] or 0 if done else 0

    query = ingest.run_forever(stream, str(tmp_path / "check"), flush.parts_sink(out, ledger), seconds=1, mode="append")
    try:
        until = time.time() + 300
        while time.time() < until and noted() < 15:  # the ledger's note comes last
            time.sleep(1)
        assert query.exception() is None
    finally:
        query.stop()
    assert len(seen(spark, out)) == 15
    assert noted() == 15


def test_at_least_one_row(spark):
    with pytest.raises(ValueError):
        flush.Flush(spark.createDataFrame([], SCHEMA).schema, 0, 1)


def test_whole_flushes_go_out_in_one_frame(spark):
    import pandas as pd

    class Handle(list):
        def getListState(self, *a):
            return self

        appendList = list.extend

        def get(self):
            return iter(list(self))

        def getValueState(self, *a):
            class Value:
                now = None

                def get(self):
                    return self.now

                def update(self, now):
                    self.now = now

            return Value()

    columns = spark.createDataFrame([], "chunk_id string, n int").schema
    task, handle = flush.Flush(columns, 10, None), Handle()
    task.init(handle)
    frame = lambda a, b: pd.DataFrame({"chunk_id": "c", "n": range(a, b)})
    assert list(task.handleInputRows(("c",), iter([frame(0, 4), frame(4, 7)]), None)) == [] and len(handle) == 7
    (out,) = task.handleInputRows(("c",), iter([frame(7, 30), frame(30, 45)]), None)
    assert out.n.tolist() == list(range(40)) and out.flush.tolist() == [i // 10 + 1 for i in range(40)]
    assert list(handle) == [("c", n) for n in range(40, 45)] and task.state.get() == (5, 4)
