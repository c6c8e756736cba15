import random

import numpy as np
import xxhash

from corpusloom.llm.simhash import fingerprint, near_links, simhash_groups, spanning, trie_pairs
from tests.llm.helpers import documents, rows


def brute_print(text):
    out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", out) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, f) in enumerate(prints):
        for e, g in prints[:i]:
            if bin(f ^ g).count("1") <= 3:
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: find(d) for d, _ in prints}


def test_fingerprint_is_the_written_definition():
    for text in ["", "One", "one  two", "A b\tc d\ne", "é É x y z " * 9, "a a a a a"]:
        assert fingerprint(text.encode()) == brute_print(text)


def test_trie_finds_exactly_the_near_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(5)]
    values = np.unique(np.concatenate([base, *flips]))
    near = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if bin(int(values[i] ^ values[j])).count("1") <= 3}
    found = {(int(x), int(y)) for i, j in trie_pairs(values, values, 0, 3) for x, y in zip(i, j)}
    assert found == near
    top = values >> np.uint64(62)
    got = set()
    for p in range(4):
        for q in range(p, 4):
            a, b = values[top == p], values[top == q]
            a_at, b_at = np.flatnonzero(top == p), np.flatnonzero(top == q)
            b = a if p == q else b
            got |= {(int(a_at[x]), int(b_at[y])) for i, j in trie_pairs(a, b, 2, 3) for x, y in zip(i, j)}
    assert got == near


def test_spanning_keeps_the_smallest():
    pairs = [(np.array([3, 5]), np.array([4, 6])), (np.array([4]), np.array([5]))]
    assert spanning(8, iter(pairs)).tolist() == [0, 1, 2, 3, 3, 3, 3, 7]


def test_groups_equal_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(30):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 200]))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 3])):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper())
    texts += [None, "", " \n", "word", "WORD"]
    docs = documents(spark, list(enumerate(texts)))
    prints = [(i, brute_print(t)) for i, t in enumerate(texts)]
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_groups(docs).collect()}
    assert got == {d: (f"{f:016x}", want[d]) for d, f in prints}


def test_blocks_of_the_trie_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base ^ np.uint64(7), base ^ np.uint64(1 << 62), base ^ np.uint64((1 << 60) | 56)]))
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")

    def classes(per_block):
        links = [(r.u, r.v) for r in near_links(prints, 3, per_block).collect()]
        at = {int(v): i for i, v in enumerate(values.view(np.int64))}
        one = [(np.array([at[u] for u, _ in links]), np.array([at[v] for _, v in links]))] if links else []
        return spanning(len(values), iter(one)).tolist()

    assert classes(4) == classes(1 << 16)


def test_edge_rows(spark):
    docs = documents(spark, [(None, "a b c"), (1, "a b c"), (1, "a b c")])
    assert {r.component_id for r in simhash_groups(docs).collect()} == {1}
    assert rows(simhash_groups(documents(spark, []))) == []
