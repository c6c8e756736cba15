import hashlib
import random

import numpy as np

from corpusloom.llm.exact_dedup import exact_dedup, filter_of, merged, packed, repeated_fingerprints, unpacked
from tests.llm.helpers import documents, rows


def test_filters_pack_and_merge_without_loss():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    prints = np.concatenate([prints, prints[:700], prints[:9], np.array([0, (1 << 64) - 1], np.uint64)])
    parts = [filter_of(p) for p in np.array_split(prints, 7)]
    for keys, counts in parts:
        back = unpacked(packed(keys, counts))
        assert (back[0] == keys).all() and (back[1] == counts).all()
    keys, counts = merged([unpacked(packed(*p)) for p in parts])
    want = np.unique(prints, return_counts=True)
    assert (keys == want[0]).all() and (counts == want[1]).all()


def test_repeated_fingerprints_over_blocks(spark):
    rng = random.Random(2)
    values = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(300)]
    values += values[:50] + values[:5]
    df = spark.createDataFrame([(v,) for v in values], "fp long").repartition(6)
    for rows_ in (len(values), 1 << 24):  # one block, and many
        got = {r.fp: r.copies for r in repeated_fingerprints(df, rows_).collect()}
        assert got == {v: values.count(v) for v in set(values) if values.count(v) > 1}


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [rng.choice(["a", "A", "b c", "É", "é", "", " ", None, "x" * 5000, f"only {i}"]) for i in range(200)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(documents(spark, list(enumerate(texts)))).collect()}
    norm = ["".join(c.lower() if c.isascii() else c for c in t or "") for t in texts]
    groups = {}
    for i, t in enumerate(norm):
        groups.setdefault(t, []).append(i)
    assert got == {i: (max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)}


def test_edge_rows(spark):
    assert rows(exact_dedup(documents(spark, []))) == []
    got = rows(exact_dedup(documents(spark, [(None, "a"), (3, "A"), (3, "a"), (None, "z"), (None, "Z")])))
    assert [r[:4] for r in got] == sorted([(3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (None, None, 2, True), (None, None, 2, True)], key=str)
