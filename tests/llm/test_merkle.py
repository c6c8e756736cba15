import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from corpusloom.llm import merkle
from corpusloom.llm._shared import id_crc, lowered
from tests.llm.helpers import F, documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests, arity):
    """The top, and for each leaf its siblings' runs: (place in the run, the run)."""
    steps, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + arity] for i in range(0, len(digests), arity)]
        for k, p in enumerate(at):
            steps[k].append((p % arity, runs[p // arity]))
        at = [p // arity for p in at]
        digests = [h(*r) for r in runs]
    return digests[0], steps


def brute(data, arity, presented):
    """data: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in order:
        members = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[s] = members, *tree([leaf(r) for r in members], arity)
    root, above = tree([made[s][1] for s in order], arity)
    out = []
    for s, over in zip(order, above, strict=True):
        members, subroot, steps = made[s]
        for row, own in zip(members, steps, strict=True):
            digest, siblings = leaf((*row[:4], presented(row))), []
            for at, run in [*own, *over]:
                siblings += run[:at] + run[at + 1 :]
                digest = h(*run[:at], digest, *run[at + 1 :])
            out.append((row[0], leaf(row), subroot, root, h(*siblings), digest, digest == root))
    return sorted(out, key=str)


def frame(spark, data):
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, place long, size string, _at int, path string"
    return spark.createDataFrame([(*r, "t", 7, "s", 1, "p") for r in data], schema)


def low(text):
    return None if text is None else "".join(c.lower() if c.isascii() else c for c in text)


def tampering(row):
    return low(row[4]) if zlib.crc32(str(row[0] if row[0] is not None else "").encode()) % 5 == 0 else row[4]


def proofs(df, arity=16):
    tampered = F.when(F.col("text").isNotNull() & (id_crc(F.col("doc_id")) % 5 == 0), lowered(F.col("text"))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.manifest(df, tampered, arity).collect()), key=str)


@pytest.mark.parametrize(("arity", "parts"), [(16, 4), (2, 7), (3, 1)])
def test_proofs_equal_brute_force(spark, arity, parts):
    """With two children a parent, the larger tree has ten levels, so parts meet in several rounds and paths go down through several."""
    rng = random.Random(arity)
    data = [(i, rng.choice(["hot"] * 6 + ["é", "a", None]), rng.choice(["en", None]), i, rng.choice(["Aa", "bb", "É", "", "x" * 3000])) for i in range(900)]
    data += [(1000, "lone", "en", 1, "One"), (-5, "lone2", "en", None, None)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert proofs(frame(spark, data), arity) == brute(data, arity, tampering)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_nulls_ties_repeats_and_very_long_texts(spark):
    data = [(1, "s", "en", 1, None), (1, "s", "en", 1, ""), (1, "s", "en", 1, None), (None, "s", None, None, "B"), (None, None, None, None, None), (2, "", "en", 3, "Ü:1-" * 500_000), (5, "s", "en", 1, "Q")]
    data += [(7, "t", "en", 1, "same")] * 40
    assert proofs(frame(spark, data)) == brute(data, 16, tampering)
    assert leaf((1, "s", "en", 1, None)) != leaf((1, "s", "en", 1, "-"))


def test_one_row_and_none(spark):
    assert proofs(frame(spark, [])) == []
    data = [(3, "s", "en", 1, "X")]
    assert proofs(frame(spark, data)) == brute(data, 16, tampering)
    assert brute(data, 16, tampering)[0][4] == h("")


def test_any_changed_field_is_found(spark):
    df = documents(spark, [(i, f"text {i}") for i in range(50)])
    got = merkle.manifest(df, F.when(F.col("doc_id") == 17, F.lit("text 71")).otherwise(F.col("text"))).collect()
    assert [r.doc_id for r in got if not r.verified] == [17] and len(got) == 50
    assert len({r.root for r in got}) == 1 and len({r.proof_sha256 for r in got}) == 50


def test_events_in_any_order_and_few_held(monkeypatch):
    """Children that come in any order, and tasks that may hold few partial parents, give the same nodes in the end."""
    rng = random.Random(4)
    digests = [h(str(i)) for i in range(300)]
    events = [("t", 300, 0, i, d) for i, d in enumerate(digests)]
    rng.shuffle(events)
    monkeypatch.setattr(merkle, "HELD", 3)
    names = ["tree", "size", "level", "place", "digest"]
    found, waiting, rounds = [], events, 0
    while waiting:
        batch = pa.RecordBatch.from_pylist([dict(zip(names, e, strict=True)) for e in sorted(waiting, key=lambda e: (e[2], e[3]) if rounds else 0)])
        out = [tuple(r.values()) for b in merkle._climb(4)(iter([batch])) for r in b.to_pylist()]
        found += [r for r in out if r[5] is not None]
        waiting = [r[:5] for r in out if r[5] is None]
        rounds += 1
    assert rounds > 1 and [r[4] for r in found if r[6]] == [tree(digests, 4)[0]]
    assert len(found) == 75 + 19 + 5 + 2 + 1
