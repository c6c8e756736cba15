"""A plan that grows has the chunks of the whole plan, holds its tail, and survives being stopped."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import planning
from corpusloom.streaming import ingest
from corpusloom.streaming.plan_builder import PlanBuilder

SCHEMA = "text_sha256 string, file_idx long, prompt_tokens int"


def texts(files, seed=1):
    rng = random.Random(seed)
    return [(f"{rng.randrange(16**6):06x}{f}", f, rng.randrange(90)) for f in files for _ in range(rng.randrange(5, 30))]


def ids(df):
    return sorted((r.ordinal, r.group, r.chunk_id, r.text_sha256) for r in df.collect())


def whole(spark, data, size, final=True):
    return ids(planning.chunked(planning.file_ordinal(spark.createDataFrame(data, SCHEMA)), size, F.lit("f"), final))


def test_chunks_after_appends_equal_the_whole_plan(spark, tmp_path):
    data, builder = texts(range(6)), PlanBuilder(spark, str(tmp_path / "p"), 7, F.lit("f"))
    assert builder.emitted() is None and builder.emit() == 0
    for k, files in enumerate([(0, 1), (2,), (3, 4, 5)]):
        some = [t for t in data if t[1] in files] + ([data[0]] if k else [])  # one that is known comes again
        builder.append(spark.createDataFrame(some, SCHEMA), k)
        builder.emit(per=2)
        so_far = [t for t in data if t[1] <= files[-1]]
        assert builder.waiting() == len(so_far) % 7  # the tail
        assert ids(builder.emitted()) == whole(spark, so_far, 7, final=False)
    assert builder.append(spark.createDataFrame(texts([9]), SCHEMA), 2) == builder.plan() and builder.emit() == 0  # append 2 is in
    assert builder.emit(final=True) == (len(data) % 7 > 0) and builder.waiting() == 0
    assert ids(builder.emitted()) == whole(spark, data, 7)
    builder.append(spark.createDataFrame(texts([8], 3), SCHEMA), 3)  # goes on behind the partial chunk
    builder.emit(final=True)
    sizes = {r["group"]: r["count"] for r in builder.emitted().groupBy("group").count().collect()}
    assert sorted(sizes) == list(range(len(sizes))) and sizes[len(data) // 7] == len(data) % 7


def test_emission_stops_between_batches(spark, tmp_path):
    data, builder, seen = texts(range(3), 2), PlanBuilder(spark, str(tmp_path / "p"), 3, F.lit("f")), []
    builder.append(spark.createDataFrame(data, SCHEMA), 0)
    assert builder.emit(per=4, on_batch=seen.append, should_stop=lambda: len(seen) == 2) == 8 and seen == [4, 8]
    assert builder.waiting() == len(data) - 24
    builder.emit(final=True, per=100, on_batch=seen.append)
    assert seen[2:] == [-(-len(data) // 3) - 8] and ids(builder.emitted()) == whole(spark, data, 3)
    with pytest.raises(ValueError):
        PlanBuilder(spark, str(tmp_path / "p"), 0, F.lit("f"))


def test_lost_between_writing_and_counting(spark, tmp_path, monkeypatch):
    data, builder = texts(range(2), 4), PlanBuilder(spark, str(tmp_path / "p"), 4, F.lit("f"))

    def lost(*a, **k):
        raise OSError("lost")

    for step in (lambda: builder.append(spark.createDataFrame(data, SCHEMA), 0), lambda: builder.emit(final=True)):
        with monkeypatch.context() as m:
            m.setattr(PlanBuilder, "_keep", lost)
            with pytest.raises(OSError):
                step()
        step()
    assert ids(builder.emitted()) == whole(spark, data, 4)


def test_a_stream_of_texts(spark, tmp_path):
    data, builder = texts(range(4), 5), PlanBuilder(spark, str(tmp_path / "p"), 5, F.lit("f"))
    for f in range(4):
        spark.createDataFrame([t for t in data if t[1] == f], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        ingest.run_available(stream, f"{tmp_path}/check", builder.sink(per=50), "append").awaitTermination(120)
    assert ids(builder.emitted()) == whole(spark, data, 5, final=False)


def test_what_nobody_watches_goes_out_in_one_write(spark, tmp_path):
    data, builder = texts(range(3), 6), PlanBuilder(spark, str(tmp_path / "p"), 3, F.lit("f"))
    builder.append(spark.createDataFrame(data, SCHEMA), 0)
    assert builder.emit(final=True, per=2) == -(-len(data) // 3) > 2 and builder.plan().emissions == 1
    assert ids(builder.emitted()) == whole(spark, data, 3)
