"""Bounded pulls of manifests, and progress that lets finished chunks go."""

import json
import os
import random

import pytest

from corpusloom.sources import pulls
from corpusloom.sources.pulls import Limits, Pull, next_pull
from corpusloom.streaming import ingest, progress


class Store:
    """Manifests by chunk with the times at which they came."""

    def __init__(self):
        self.chunks, self.listed, self.down = {}, [], False

    def add(self, chunk, name, at):
        self.chunks.setdefault(chunk, []).append((name, at))

    def names(self):
        return list(self.chunks)

    def files(self, chunk):
        if self.down:
            raise OSError("too many requests")
        self.listed.append(chunk)
        return self.chunks.get(chunk, [])


def pulled(store, last, now, live, limits):
    """The next pull, through the form in which it is kept."""
    store.listed.clear()
    again = Pull(**json.loads(json.dumps({**vars(last)})))
    pull = next_pull(again, now, live, limits, store.names, store.files)
    assert sum(map(len, pull.take.values())) <= limits.files and len(store.listed) <= limits.folders
    return pull


def test_a_full_listing_over_several_pulls_takes_each_file_once():
    store = Store()
    for c in range(10):
        for i in range(7):
            store.add(f"c{c}", f"{i}.json", 100.0)
    pull, taken = Pull(), []
    for _ in range(9):
        pull = pulled(store, pull, 1000.0, set(), Limits(folders=4, files=9, slack=0))
        taken += [(c, n) for c, names in pull.take.items() for n in names]
    assert sorted(taken) == sorted((c, n) for c in store.chunks for n, _ in store.chunks[c]) and pull.settled() and pull.full_at == 1000.0
    pull = pulled(store, pull, 1100.0, set(), Limits())
    assert not pull.take and not store.listed  # nothing is due


def test_owed_before_live_before_full():
    store, limits = Store(), Limits(folders=100, files=100, slack=0)
    for c in "abc":
        store.add(c, "0.json", 50.0)
    pull = pulled(store, Pull(), 100.0, {"a", "b"}, limits)
    assert pull.take == {"a": ["0.json"], "b": ["0.json"], "c": ["0.json"]}  # the first pull lists all
    for c in "abc":
        store.add(c, "1.json", 150.0)
    pull = pulled(store, pull, 200.0, {"a"}, limits)  # b's work has ended
    assert pull.take == {"b": ["1.json"]} and store.listed == ["b"]
    pull = pulled(store, pull, 100.0 + limits.live, {"a"}, limits)  # a is due
    assert pull.take == {"a": ["1.json"]} and store.listed == ["a"]
    pull = pulled(store, pull, 100.0 + limits.reconcile, {"a"}, limits)  # all are due; a was listed since
    assert store.listed[:1] == ["a"] and pull.take["c"] == ["1.json"] and "1.json" not in pull.take.get("a", [])


def test_what_a_pull_has_no_room_for_stays_owed():
    store, limits = Store(), Limits(folders=100, files=3, slack=0)
    pull = pulled(store, Pull(), 1.0, {"a", "b"}, limits)
    for c in "ab":
        for i in range(4):
            store.add(c, f"{i}.json", 5.0)
    taken = []
    for now in (10.0, 11.0, 12.0):
        pull = pulled(store, pull, now, set(), limits)
        taken.append(pull.take)
    assert taken == [{"a": ["0.json", "1.json", "2.json"]}, {"a": ["3.json"], "b": ["0.json", "1.json"]}, {"b": ["2.json", "3.json"]}] and pull.settled()


def test_a_store_that_refuses_loses_nothing():
    store, limits = Store(), Limits(slack=0)
    pull = pulled(store, Pull(), 1.0, {"a"}, limits)
    store.add("a", "0.json", 5.0)
    store.down = True
    pull = pulled(store, pull, 10.0, set(), limits)
    assert pull.limited and not pull.take and list(pull.owed) == ["a"]
    store.down = False
    pull = pulled(store, pull, 11.0, set(), limits)
    assert pull.take == {"a": ["0.json"]} and pull.settled()


def test_unknown_live_chunks_want_all_and_late_clocks_lose_nothing():
    """At random: files that come at any time, with times up to 20 seconds behind, are all taken in the end."""
    for seed in range(20):
        rng, store, pull, now, taken = random.Random(seed), Store(), Pull(), 1000.0, set()
        limits = Limits(folders=rng.randint(2, 9), files=rng.randint(2, 9), reconcile=60, live=10, slack=20)
        every = [f"c{i}" for i in range(6)]
        for step in range(120):
            now += rng.randrange(1, 9)
            for _ in range(rng.randrange(2) if step < 60 else 0):
                store.add(rng.choice(every), f"{len(taken)}-{step}-{rng.random()}.json", now - rng.random() * 19)
            live = {c for c in every if rng.random() < 0.3} if step < 60 else set()
            pull = pulled(store, pull, now, live if rng.random() < 0.9 else None, limits)
            taken |= {(c, n) for c, names in pull.take.items() for n in names}
        assert taken == {(c, n) for c, names in store.chunks.items() for n, _ in names}, seed


@pytest.fixture
def rocks(spark):
    for k, v in progress.ROCKSDB.items():
        spark.conf.set(k, v)
    yield
    for k in progress.ROCKSDB:
        spark.conf.unset(k)


def manifest(folder, part, texts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{part}.json").write_text(json.dumps({"part_id": part, "text_sha256s": texts}))


def test_three_pulls_and_restarts_take_each_part_once_and_state_goes(spark, tmp_path, rocks):
    root, log, out, check = (tmp_path / n for n in ("fp", "log", "out", "check"))
    for c in range(4):
        for p in range(3):
            manifest(root / f"c{c}", f"p{c}{p}", [f"t{c}{p}{i}" for i in range(5)] + [f"t{c}"])
    (root / "c0" / "torn.json").write_text('{"part_id": "x", "text_sha')
    lines = spark.createDataFrame([("c0", 16), ("c1", 16), ("c2", 99), ("c3", 17)], "chunk_id string, size long")
    rows = []

    def pull(die=False):
        stream = pulls.manifest_pulls(spark, str(root), str(log), limits=Limits(files=5, slack=0))

        def sink(batch, number):
            rows.extend((r.chunk_id, r.part_id) for r in batch.select("chunk_id", "part_id").distinct().collect())
            if die:
                raise RuntimeError("lost")

        query = ingest.run_available(stream, str(check / "raw"), sink, "append")
        if die:
            with pytest.raises(Exception, match="lost"):
                query.awaitTermination(120)
            rows.clear()  # what a sink had before it was lost
        else:
            query.awaitTermination(120)

    pull(die=True)
    for _ in range(3):
        pull()
    assert sorted(rows) == [(f"c{c}", f"p{c}{p}") for c in range(4) for p in range(3)]  # 13 files, five at a time, each once
    assert [n for n in sorted(os.listdir(log)) if n.startswith("pull")] in (["pull-000000002.json", "pull-000000003.json"], ["pull-000000003.json"])

    def advance():
        stream = pulls.manifest_pulls(spark, str(root), str(tmp_path / "log2"), limits=Limits(files=7, reconcile=0, slack=3600))  # reads many files again
        ingest.run_available(progress.chunk_progress(stream, lines), str(check / "p"), ingest.versions_to(str(out))).awaitTermination(120)
        got = {r.chunk_id: (r.done, r.parts, r.complete) for r in ingest.latest(spark, str(out), "chunk_id").collect()}
        return got, {r.chunk_id: r.held for r in progress.held(spark, str(check / "p")).collect()}

    advance()
    got, held = advance()
    assert got == {"c0": (16, 3, True), "c1": (16, 3, True), "c2": (16, 3, False), "c3": (16, 3, False)}
    assert held == {"c2": 16, "c3": 16}  # finished chunks have no rows of state
    manifest(root / "c3", "late", ["new", "t3"])
    manifest(root / "c0", "late", ["more"])
    advance()
    got, held = advance()
    assert got["c3"] == (17, 4, True) and got["c0"] == (16, 3, True) and held == {"c2": 16}
