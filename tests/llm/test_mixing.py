import random

import pytest

from corpusloom.llm.mixing import CURRICULUM, mix, mixed, position_of
from corpusloom.llm.mixing import _segments as segments
from tests.llm.helpers import F, documents, nearly, rows


def targets(sizes, share=1.5, most=2.0):
    """Shares by weight; what is above its limit stops there and the rest is shared again."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, free, out = share * sum(sizes.values()), list(names), {}
    while free:
        level = left / sum(weight[n] for n in free)
        full = [n for n in free if level * weight[n] >= most * sizes[n]]
        if not full:
            return out | {n: level * weight[n] for n in free}
        for n in full:
            out[n] = most * sizes[n]
            left -= out[n]
            free.remove(n)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_words_taken(spark, seed):
    rng = random.Random(seed)
    texts = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 200])))) for i in range(300)]
    source = {i: None if i % 10 == 0 else "big" if i % 3 == 0 else f"s{i % 7}" for i, _ in texts}
    got = mix(documents(spark, texts, source)).collect()
    size = {i: len(t.split()) for i, t in texts}
    by = {}
    for i in size:
        by[source[i]] = by.get(source[i], 0) + size[i]
    want, taken = targets(by), {}
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == by[s] and nearly(r.target, want[s])
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.rounds == 0) and (r.rounds > 0) == (r.taken > 0)
        taken[s] = taken.get(s, 0) + r.taken
    assert all(int(want[s]) == taken[s] for s in by)
    placed = [r.position for r in got if r.position is not None]
    assert placed == sorted(placed) and placed[0] >= 0 and placed[-1] <= 1
    assert rows(mix(documents(spark, texts, source).repartition(7))) == sorted((tuple(r) for r in got), key=str)


def test_position_inverts_the_schedule(spark):
    for schedule in (*CURRICULUM, ((0.0, 0.0), (0.4, 2.0), (1.0, 0.0))):
        whole = sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(schedule, schedule[1:]))

        def integral(t, schedule=schedule):
            out = 0.0
            for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
                x = min(max(t - t0, 0), t1 - t0)
                out += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            return out

        parts = [i / 50 for i in range(51)]
        df = spark.createDataFrame([(p,) for p in parts], "p double").select("p", position_of(F.col("p"), segments(schedule)).alias("t"))
        for r in df.collect():
            assert abs(integral(r.t) / whole - r.p) < 1e-9


def test_the_mixed_documents(spark):
    texts = [(i, "word " * (i % 5)) for i in range(60)]
    source = {i: "ab"[i % 2] for i in range(60)}
    docs = documents(spark, texts, source)
    out = mixed(docs)
    assert out.columns == docs.columns
    count = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert max(count.values()) <= 2 and all(i % 5 for i in count)
    words = {s: sum(count.get(i, 0) * (i % 5) for i, _ in texts if source[i] == s) for s in "ab"}
    want = targets({s: sum(i % 5 for i, _ in texts if source[i] == s) for s in "ab"})
    assert all(abs(words[s] - want[s]) <= 4 for s in "ab")


def test_edge_rows(spark):
    assert rows(mix(documents(spark, []))) == []
    got = rows(mix(documents(spark, [(None, "a b"), (1, None), (1, "c c c"), (1, "c c c")])))
    assert sum(r[4] for r in got) == 12 and len(got) == 4
    assert all(r[3] == 0 for r in rows(mix(documents(spark, [(1, ""), (2, None)]))))
    assert rows(mixed(documents(spark, []))) == []
