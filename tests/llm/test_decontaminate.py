import random

import numpy as np

from corpusloom.llm.decontaminate import Items, contaminated, edit_distances, leaks, tokens, without_leaks
from tests.llm.helpers import documents, rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(texts, items):
    out = set()
    for t, text in enumerate(texts):
        words = tokens((text or "").encode())
        for item, of in items:
            want = tokens((of or "").encode())
            n = len(want)
            most = int(n * 0.2 + 1e-9)
            if not n:
                continue
            best = min((distance(words[s : s + n], want) for s in range(len(words)) if len(words) - s >= n - most), default=n)
            if best <= most:
                out.add((t, item, best))
    return out


def edited(rng, words, k, vocabulary):
    out = list(words)
    for _ in range(k):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(vocabulary)
        elif kind == 1:
            out.insert(at, rng.choice(vocabulary))
        elif len(out) > 1:
            del out[at]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "the an on re st ing".split() for b in "a er ly nd tion ou".split()]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([6, 7, 12, 15, 21, 30])))) for i in range(25)]
    texts = []
    for _ in range(n):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        words = items[rng.randrange(25)][1].split()
        leak = edited(rng, words, rng.randrange(0, int(len(words) * 0.3) + 1), vocabulary)
        at = rng.randrange(len(body) + 1)
        texts.append(" ".join(body[:at] + leak + body[at:]))
    return texts, items


def test_distances_are_exact():
    rng = random.Random(2)
    for n in (3, 8):
        a = [[rng.randrange(3) for _ in range(n)] for _ in range(200)]
        b = [[rng.randrange(3) for _ in range(n)] for _ in range(200)]
        length = [rng.randrange(n + 1) for _ in range(200)]
        got = edit_distances(np.array(a), np.array(length), np.array(b))
        assert got.tolist() == [distance(x[:m], y) for x, m, y in zip(a, length, b)]


def test_recall_reaches_the_target_and_nothing_false_is_found():
    want, got = set(), set()
    for seed in range(4):
        texts, items = corpus(seed, 150)
        want |= {(seed, *x) for x in brute(texts, items)}
        found = Items.of(items)
        got |= {(seed, t, found.ids[k][0], d) for t, k, d, _ in leaks([t.encode() for t in texts], found).tolist()}
    assert {x[:3] for x in got} <= {x[:3] for x in want}
    assert len(want) > 300
    assert len({x[:3] for x in got}) >= 0.99 * len(want)


def test_a_filter_over_every_window_loses_nothing():
    texts, items = corpus(9, 60)
    found = Items.of(items)
    near = {(t, found.ids[k][0]) for t, k, _, _ in leaks([t.encode() for t in texts], found, repeats=400).tolist()}
    assert near == {x[:2] for x in brute(texts, items)}


def test_table_form(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = item.replace("gamma", "GAMMA,").replace("eta theta", "eta X")
    docs = documents(spark, [(1, f"so {item} end"), (2, f"{near}!"), (3, "alpha beta gamma and nothing else here at all"), (4, None), (5, ""), (None, item), (1, item)])
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, ""), (11, "so")], "item_id long, text string")
    got = rows(contaminated(docs, bench).select("doc_id", "item_id", "distance", "start"))
    assert got == sorted([(1, 11, 0, 0), (1, 7, 0, 1), (1, 8, 0, 1), (1, 7, 0, 0), (1, 8, 0, 0), (2, 7, 1, 0), (2, 8, 1, 0), (None, 7, 0, 0), (None, 8, 0, 0)], key=str)
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    empty = bench.filter("false")
    assert rows(contaminated(docs, empty)) == [] and without_leaks(docs, empty).count() == 7
    assert rows(contaminated(docs.filter("false"), bench)) == []


def test_short_items_are_found_exactly():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "the an on re".split() for b in "a er ly".split()]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 3, 4, 5, 5, 5, 5, 5])]
    items += [(20, "zz only here"), (21, "zz two"), (22, items[4][1])]
    texts = ["", "zz", items[4][1].rsplit(" ", 1)[0], items[5][1].split(" ", 1)[1]]
    for _ in range(400):
        body = [rng.choice([*vocabulary, "x", "y"]) for _ in range(rng.randrange(0, 30))]
        words = rng.choice(items)[1].split()
        at = rng.randrange(len(body) + 1)
        texts.append(" ".join(body[:at] + edited(rng, words, rng.randrange(0, 2), vocabulary) + body[at:]))
    found = Items.of(items)
    got = {(t, i, d) for t, k, d, _ in leaks([t.encode() for t in texts], found).tolist() for i in found.ids[k]}
    want = brute(texts, items)
    assert got == want and len({i for _, i, _ in want}) > 8


def test_searched_pieces_hide_nothing(spark, monkeypatch):
    """Long texts, and batches of more than one piece."""
    from corpusloom.llm import decontaminate

    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = [(i, f"{'so it goes ' * 3000}{item if i % 3 else ''}{' and on' * (i * 500)}") for i in range(9)]
    monkeypatch.setattr(decontaminate, "PIECE", 40_000)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate.contaminated(documents(spark, texts), bench).collect()
    assert sorted((r.doc_id, r.distance, r.start) for r in got) == [(i, 0, 9000) for i in range(9) if i % 3]
