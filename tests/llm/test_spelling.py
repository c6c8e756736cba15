import random
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm.spelling import WaveletMatrix, near_pairs, variants, word_counts
from tests.llm.helpers import documents


def near(a, b):
    """Exactly one edit apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        found = sorted((-counts[v], v) for v in counts if v != w and near(w, v))
        form = found[0] if found and -found[0][0] >= ratio * n else None
        out[w] = [form[1] if form else None, None, n, len(found), -form[0] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def found(spark, counts, **limits):
    rows = variants(spark.createDataFrame(sorted(counts.items()), "word string, n long"), **limits).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_wavelet_matrix_reports_what_is_in_a_rectangle():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        matrix = WaveletMatrix(values)
        left, low = rng.integers(0, n + 1, (2, 50))
        right, high = np.minimum(left + rng.integers(0, n + 1, 50), n), np.minimum(low + rng.integers(0, n + 1, 50), n)
        query, value = matrix.report(left, right, low, high)
        want = sorted((q, v) for q in range(50) for v in values[left[q] : right[q]].tolist() if low[q] <= v < high[q])
        assert sorted(zip(query.tolist(), value.tolist(), strict=True)) == want
    assert [x.tolist() for x in WaveletMatrix(np.empty(0, np.int64)).report(*[np.empty(0, np.int64)] * 4)] == [[], []]


@pytest.mark.parametrize("length", [1, 2, 3, 5, 8])
def test_near_pairs_equal_brute_force_once_each(length):
    rng = random.Random(length)
    words = sorted({"".join(rng.choice("abà") for _ in range(length + rng.randrange(2))) for _ in range(150)})
    rng.shuffle(words)
    want = sorted((i, j) for i, x in enumerate(words) for j, y in enumerate(words) if near(x, y) and min(len(x), len(y)) == length)
    for cuts in ([0, length + 1], [0, (length + 1) // 2, length + 1], list(range(length + 2))):  # whole, by half, by single position
        got = [p for lo, hi in zip(cuts, cuts[1:], strict=False) for p in zip(*(x.tolist() for x in near_pairs(words, length, lo, hi)), strict=True)]
        assert sorted(got) == want


def misspelt(seed, n):
    rng, counts = random.Random(seed), Counter()
    stems = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(7, 12))) for _ in range(n)] + ["prefixed" + c + d for c in "abcdef" for d in "xyz"]
    for stem in stems:
        counts[stem] += rng.choice([3, 50, 4000, 40])
        for _ in range(6):
            i, word = rng.randrange(len(stem)), stem
            word = rng.choice([stem[:i] + stem[i + 1 :], stem[:i] + rng.choice("abé") + stem[i:], stem[:i] + rng.choice("abé") + stem[i + 1 :]])
            counts[word] += rng.choice([2, 2, 30])
    return counts


def test_variants_equal_brute_force(spark):
    counts = misspelt(1, 60)
    want = brute(counts)
    assert any(r[1] != r[0] and r[0] for r in want.values()), "no chain of forms"
    assert found(spark, counts) == want


def test_hot_parts_are_cut_until_they_fit(spark):
    """Half of the words begin alike, half end alike, and groups hold 9 words only."""
    counts = misspelt(2, 12)
    rng = random.Random(5)
    counts |= {"beginning" + "".join(rng.choice("ab") for _ in range(5)): rng.choice([2, 30, 400]) for _ in range(60)}
    counts |= {"".join(rng.choice("ab") for _ in range(5)) + "ending": rng.choice([2, 30, 400]) for _ in range(60)}
    assert found(spark, counts, most_words=9) == brute(counts)


def test_ties_long_words_and_no_words(spark):
    long = "ab" * 30_000
    counts = {"aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaab": 20, "aaaaaaé": 20, long: 3, long + "b": 30, "x" + long: 300, "alone": 5}
    assert found(spark, counts) == brute(counts)
    assert found(spark, counts)["aaaaaaa"][0] == "aaaaaaaa"  # of three with 20, the smallest
    assert found(spark, {}) == {}


def test_words_of_documents(spark):
    texts = ["Straße straße STRASSE×Übung übung", "It's naïveté, naïveté and Naïveté; short words", None, "", "çédille×÷ ÇÉDILLE " * 20, "repeated repeated", "letters " * 40_000]
    data = [(i, t) for i, t in enumerate(texts)] + [(5, "repeated repeated"), (None, "without without without"), *((100 + i, "frequent frequent wording") for i in range(80))]
    want = Counter()
    for i, text in data:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if run and h % 31 == 0 else run
            want[word] += len(word) >= 7
            run = ""
    assert {r.word: r.n for r in word_counts(documents(spark, data)).collect()} == {w: n for w, n in want.items() if n >= 2}
    assert "frequnt" in want or any(len(w) == 7 and w not in ("wording", "letters") for w in want)
    assert word_counts(documents(spark, [])).collect() == []
