"""Job records on a clock that can't go back, from a table and from a stream."""

import datetime as dt
import random

from corpusloom.operators.timelines import timeline_records
from corpusloom.streaming import ingest

SCHEMA = "job string, wall timestamp, mono double, kind string, env_ready string, walltime_s long, assigned_texts long"
START = dt.datetime(2024, 3, 31, 0, 59, 50)


def events(seed=1, jobs=20):
    rng, out = random.Random(seed), []
    for j in range(jobs):
        mono, step, wall = rng.random() * 1e6, 0.0, START + dt.timedelta(seconds=rng.randrange(10**6))
        kinds = ["started"] + ["engine_ready"] * rng.randrange(2) + ["result"] * rng.randrange(4) + ["signal"] * rng.randrange(2)
        for kind in kinds:
            jump = dt.timedelta(hours=rng.choice([0, 0, -3, 5])) if kind != "started" else dt.timedelta()  # the wall clock is set
            out.append((f"j{j}", wall + dt.timedelta(seconds=step) + jump, mono + step, kind, rng.choice([None, "x", "-3", "42"]) if kind == "started" else None, 7200 if kind == "started" else None, 100 + j if kind == "started" else None))
            step += rng.randrange(1, 10**7) / 1e4
    return out


def record(rows):
    """One job's, event by event."""
    rows = sorted(rows, key=lambda r: r[2])
    first = rows[0]
    at = lambda m: None if m is None else (first[1] + dt.timedelta(seconds=m - first[2])).isoformat(timespec="seconds") + "+00:00"
    of = lambda k: [r[2] for r in rows if r[3] == k]
    ready, results = of("engine_ready"), of("result")
    env = first[4] if first[4] and first[4].isdigit() else None
    return (first[0], at(first[2]), int(env) if env else None, at(ready[0] if ready else None), at(results[0] if results else None), at(results[-1] if results else None), at(rows[-1][2]), first[5], first[6])


def expected(data):
    return sorted((record([r for r in data if r[0] == j]) for j in {r[0] for r in data}), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_records_equal_a_replay_in_any_order(spark):
    data = events()
    shuffled = random.Random(3).sample(data, len(data))
    assert got(timeline_records(spark.createDataFrame(shuffled, SCHEMA).repartition(5))) == expected(data)
    assert all(r[1] <= (r[4] or r[1]) <= (r[5] or r[1]) <= r[6] for r in expected(data))
    assert got(timeline_records(spark.createDataFrame([], SCHEMA))) == []
    assert got(timeline_records(spark.createDataFrame([("a", START, None, "result", None, 1, 1), ("b", None, 2.0, "result", None, None, None)], SCHEMA))) == [("b", *[None] * 8)]


def test_a_stream_of_events(spark, tmp_path):
    data = sorted(events(2), key=lambda r: r[2])
    for part in (data[::2], data[1::2]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = timeline_records(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"))
        ingest.run_available(stream, f"{tmp_path}/check", ingest.versions_to(f"{tmp_path}/out")).awaitTermination(120)
    assert got(ingest.latest(spark, f"{tmp_path}/out", "job").select("job", "started_at", "env_ready_seconds", "engine_ready_at", "first_result_at", "last_result_at", "ended_at", "walltime_s", "assigned_texts")) == expected(data)
