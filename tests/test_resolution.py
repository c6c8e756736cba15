"""Verdicts in levels of runs: equal to one reduction of everything, with few files, whatever is broken off."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.resolve import verdicts
from corpusloom.streaming import resolution
from corpusloom.streaming.resolution import ResolutionStore, catch_up

SCHEMA = "text_sha256 string, raw_output string, truncated boolean"
ANSWERS = ["x</think>yes", "x</think>no", "x", "", "x</think>yes and no"]


def batches(n, seed=1):
    rng = random.Random(seed)
    keys = [f"c{rng.randrange(5)}/p{i:02}" for i in range(n)]
    rng.shuffle(keys)
    return [[(f"t{rng.randrange(30)}", rng.choice(ANSWERS), rng.random() < 0.1, key, i) for i in range(rng.randrange(1, 12))] for key in keys]


def frame(spark, rows):
    return spark.createDataFrame(rows, f"{SCHEMA}, part_key string, row_index long")


def found(df):
    return sorted(tuple(r[c] for c in ("text_sha256", "decision", "parse_mode", "failure_reason", "part_key")) for r in df.collect())


def test_runs_are_few_and_equal_the_whole(spark, tmp_path):
    store, data = ResolutionStore(spark, str(tmp_path), buckets=2, fanout=2), batches(9)
    for i, rows in enumerate(data):
        state = store.add(frame(spark, rows), i)
        assert all(len(level) < 2 for level in state.runs) and len(state.names()) == bin(i + 1).count("1")  # as a binary counter
    whole = frame(spark, [r for rows in data for r in rows])
    assert found(store.verdicts()) == found(verdicts(whole))
    assert len(store.verdicts().inputFiles()) <= 2 * len(state.names())
    kept = {p.name for p in (tmp_path / f"v{resolution.PARSER_VERSION}" / "runs").iterdir()}
    assert {f"run={n}" for n in state.names()} <= kept and len(kept) <= len(state.names()) + 4  # those of the state before may still be read


def test_a_batch_twice_and_a_batch_broken_off(spark, tmp_path, monkeypatch):
    store, data = ResolutionStore(spark, str(tmp_path), buckets=2, fanout=2), batches(4, 2)
    for i in (0, 1, 2):
        store.add(frame(spark, data[i]), i)
    before = store.levels()
    store.add(frame(spark, data[0]), 2)  # run again after it was counted: whatever it holds, it is in already
    assert store.levels() == before

    def lost(self, state):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ResolutionStore, "_keep", lost)
        with pytest.raises(OSError):
            store.add(frame(spark, data[3]), 3)
    assert store.levels() == before  # runs that no state names don't count
    store.add(frame(spark, data[3]), 3)
    assert found(store.verdicts()) == found(verdicts(frame(spark, [r for rows in data for r in rows])))


def test_no_batches_and_another_parser(spark, tmp_path):
    store = ResolutionStore(spark, str(tmp_path))
    assert store.verdicts().count() == 0
    store.add(frame(spark, batches(1)[0]), 0)
    assert store.verdicts().count() > 0 and ResolutionStore(spark, str(tmp_path), version="other").verdicts().count() == 0
    with pytest.raises(ValueError):
        ResolutionStore(spark, str(tmp_path), fanout=1)


def test_catching_up_reads_only_what_is_new(spark, tmp_path):
    parts, check = str(tmp_path / "parts" / "fp"), str(tmp_path / "check")
    store = ResolutionStore(spark, str(tmp_path / "store"), buckets=2, fanout=3)
    data = batches(6, 3)

    def write(some):
        for rows in some:
            spark.createDataFrame([r[:3] for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{parts}/{rows[0][3].split('/')[0]}")

    def whole():
        df = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(parts)
        return verdicts(df.selectExpr("*", "substring_index(_metadata.file_path, '/', -3) as part_key", "_metadata.row_index as row_index"))

    write(data[:4])
    assert found(catch_up(store, parts, SCHEMA, check, files=1)) == found(whole())
    assert store.levels().batch == 3 and len(store.levels().names()) == 2
    write(data[4:])
    assert found(catch_up(store, parts, SCHEMA, check, files=1)) == found(whole())
    assert store.levels().batch == 5
    made = store.levels().made
    assert found(catch_up(store, parts, SCHEMA, check)) == found(whole()) and store.levels().made == made  # nothing new: nothing written
    assert store.verdicts().filter(F.col("text_sha256").isNull()).count() == 0


def test_a_large_bucket_is_split_over_files(spark, tmp_path):
    from corpusloom.session import configured

    rows = spark.range(20_000).selectExpr("sha2(cast(id AS string), 256) AS text_sha256", "'</think>yes' AS raw_output", "false AS truncated", "'p' AS part_key", "id AS row_index").repartition(4)
    with configured(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        store = ResolutionStore(spark, str(tmp_path / "s"), buckets=1)
        store.add(rows, 0)
    assert len(list((tmp_path / "s").rglob("*.parquet"))) > 1
    assert store.verdicts().filter("decision = 'yes'").count() == 20_000
