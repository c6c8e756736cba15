import random

import numpy as np
import pytest

from corpusloom.llm import near_copies as module
from corpusloom.llm.near_copies import FAR, BITS, TABLES, _across, _may_be_similar, _prints, _proposed, marks, near_copy_groups, one_of_each_group, wide_print
from corpusloom.llm.simhash import shingles
from tests.llm.helpers import F, documents, rows

VOCABULARY = [f"w{i}" for i in range(500)]


def brute(texts):
    """Components of pairs with an exact similarity of 0.8 or more, over sets of word tuples; and those pairs."""
    sets = []
    for t in texts:
        words = (t or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root, links = list(range(len(texts))), []
    for j in range(len(texts)):
        for i in range(j):
            both = len(sets[i] | sets[j])
            if both == 0 or 5 * len(sets[i] & sets[j]) >= 4 * both:
                links.append((i, j))
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return root, links


def say(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


@pytest.mark.parametrize("per_block", [1 << 18, 16])
def test_groups_equal_brute_force(spark, per_block):
    rng, texts = random.Random(4), []
    for _ in range(40):
        words = say(rng, rng.choice([2, 30, 120, 400]))
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 4])):  # some copies are similar enough, some are not
            copy = list(words)
            for _ in range(rng.choice([1, len(words) // 60 + 1, len(words) // 30 + 1])):
                copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
            texts.append("  ".join(copy).upper())
    texts += [None, "", " \n", "word", "WORD", "long words again " * 30_000]
    want, links = brute(texts)
    assert len(links) > 20
    assert dict(near_copy_groups(documents(spark, list(enumerate(texts))), per_block).collect()) == dict(enumerate(want))


def test_chains_through_dissimilar_ends_are_followed(spark):
    """Each text is similar to its neighbours only, so that links to the smallest of a chain don't hold."""
    rng = random.Random(5)
    words, texts = say(rng, 300), []
    for k in range(24):
        texts.append(" ".join(words))
        words = words[:k * 12] + say(rng, 6) + words[k * 12 + 6 :]
    want, links = brute(texts)
    assert len(links) < 200 and set(want) == {0}
    assert {r.component_id for r in near_copy_groups(documents(spark, list(enumerate(texts)))).collect()} == {0}


def test_pairs_at_the_limit_are_near_in_bits():
    rng = np.random.default_rng(6)
    for n, common in ((5, 4), (9, 8), (90, 80), (900, 800)):  # each of n, but the first, which holds the other
        worst = 0
        for _ in range(50):
            h = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            a, b = h[:n], h[:common] if n == 5 else np.concatenate([h[:common], h[n : 2 * n - common]])
            x, y = (np.frombuffer(wide_print(s), np.uint8) for s in (a, b))
            worst = max(worst, int(np.bitwise_count(x ^ y).sum()))
        assert worst <= FAR * BITS * TABLES


def test_shingles_of_short_texts():
    assert len(shingles(b" ", 5)) == 0 and len(shingles(b"a b", 5)) == 1 and len(shingles(b"a b c d e f", 5)) == 2


def test_edge_rows(spark):
    docs = documents(spark, [(None, "a b c"), (1, "a b c"), (1, "a b c"), (None, "x"), (7, None), (8, "")])
    assert sorted(near_copy_groups(docs).collect(), key=str) == sorted([(None, 1), (1, 1), (1, 1), (None, None), (7, 7), (8, 7)], key=str)
    assert sorted((r.doc_id, r.text) for r in one_of_each_group(docs.filter("doc_id is not null")).collect()) == [(1, "a b c"), (7, None)]
    assert rows(near_copy_groups(documents(spark, []))) == []


def test_marks_drop_no_similar_pair():
    rng = np.random.default_rng(8)
    dropped = 0
    for _ in range(400):
        n, share = int(rng.integers(1, 400)), rng.uniform(0.5, 1)
        h, common = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64), max(1, int(n * share))
        a, b = h[:n], np.concatenate([h[:common], h[n : 2 * n - common]])
        marked, size = np.frombuffer(marks(a) + marks(b), np.uint64).reshape(2, -1), np.array([n, n])
        may = bool(_may_be_similar(marked, size, np.array([0]), np.array([1]))[0])
        assert may or common < 0.8 * (2 * n - common)
        dropped += not may
    assert dropped > 100


def test_texts_that_are_alike_but_not_similar_make_no_rows(spark):
    """A base text with many variants, each two of which have a similarity of some 0.65: the tries propose nearly all of their pairs."""
    rng = random.Random(9)
    words, texts = say(rng, 100), []
    for i in range(120):
        copy = list(words)
        for at in rng.sample(range(0, 100, 5), 2):
            copy[at] = f"x{i}y{at}"
        texts.append(" ".join(copy))
    nodes = _prints(documents(spark, list(enumerate(texts)))).withColumn("u", F.col("doc_id")).withColumn("root", F.col("doc_id")).drop("doc_id", "k1", "k2")
    unproven = nodes.withColumn("size", F.lit(1 << 40))  # so large that marks prove nothing
    assert _proposed(unproven, 120, _across, 1 << 18).count() > 1000
    got = {(r.v, r.u) for r in _proposed(nodes, 120, _across, 1 << 18).collect()}
    assert len(got) < 400 and len(set(brute(texts)[1]) - got) <= 1  # a pair at the limit is proposed with probability 0.9998


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Variants of a text with one to three edits: four in all are similar, five are not. The first comparison, which leaves some of a large group apart, is left out."""
    rng = random.Random(12)
    words, texts, n = say(rng, 200), [], 150
    for i in range(n):
        copy = list(words)
        for at in rng.sample(range(5, 195, 6), rng.choice([1, 2, 3])):
            copy[at] = f"x{i}y{at}"
        texts.append(" ".join(copy))
    tables, staged, verified = {}, module.staged, module._verified
    monkeypatch.setattr(module, "_verified", lambda *a: verified(*a).filter(F.lit(a[-1] != "near")))
    monkeypatch.setattr(module, "staged", lambda df, name: tables.update({name: staged(df, name)}) or tables[name])
    want, links = brute(texts)
    assert len(links) > 5000 and set(want) == {0}
    assert near_copy_groups(documents(spark, list(enumerate(texts)))).count() == n  # links of the first comparison aren't found again
    pairs = tables["near-more-near"].count() if "near-more-near" in tables else 0
    assert pairs < 10 * n, pairs


def test_short_pairs_at_the_limit_are_linked(spark):
    """Texts of nine words and the same without the last: 4 of 5 shingles. Of the fingerprints' tries, which proposed 0.94 of them, many were lost."""
    rng, texts = random.Random(14), []
    for k in range(400):
        words = [f"v{k}x{rng.randrange(1 << 30)}" for _ in range(9)]
        texts += [" ".join(words), " ".join(words[:-1])]
    linked = near_copy_groups(documents(spark, list(enumerate(texts)))).filter("doc_id % 2 = 1 and component_id = doc_id - 1").count()
    assert linked >= 398, linked


def unrooted(spark, texts):
    return _prints(documents(spark, list(enumerate(texts)))).withColumn("u", F.col("doc_id")).withColumn("root", F.col("doc_id")).drop("doc_id", "k1", "k2")


def test_a_text_moves_in_as_many_rows_however_many_there_are(spark, monkeypatch):
    """It was dealt out in four times as many rows once there were more texts than a block holds."""
    rng, n, grouped, dealt = random.Random(13), 60, [], []
    nodes = unrooted(spark, [" ".join(say(rng, 60)) for _ in range(n)])
    kind, group_by = type(nodes), type(nodes).groupBy
    monkeypatch.setattr(kind, "groupBy", lambda self, *by: grouped.append(self) or group_by(self, *by))
    for per_block in (1 << 18, 8):
        grouped.clear()
        _proposed(nodes, n, _across, per_block).count()
        dealt.append(max(df.count() for df in list(grouped)))
    assert dealt[0] == dealt[1] <= 64 * n, dealt


def test_links_connect_what_pairs_connect(spark):
    rng = random.Random(15)
    words, texts = say(rng, 150), []
    for i in range(90):
        copy = list(words)
        for at in rng.sample(range(5, 145, 6), rng.choice([1, 2, 3])):
            copy[at] = f"x{i}y{at}"
        texts.append(" ".join(copy))
    nodes = unrooted(spark, texts)

    def roots(pairs):
        root = list(range(len(texts)))
        for i, j in pairs:
            root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
        return root

    pairs = [{(r.u, r.v) for r in _proposed(nodes, len(texts), task, per_block).collect()} for task in (_across, module._linking) for per_block in (1 << 18, 16)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 1000  # parts of buckets leave no pair out
    assert roots(pairs[0]) == roots(pairs[2]) == roots(pairs[3]) and len(pairs[2]) < 200


def test_words_are_hashed_alike_wherever_they_stand():
    words = [b"a", b"B", b"ab", b"ba", b"\xc3\xa9", b"\x00", b"y" * 70_000, b"y" * 70_001, b"z" * 10]
    alone = [module._word_hashes(w)[0] for w in words]
    assert len(set(alone)) == len(words)
    assert module._word_hashes(b"  " + b"\t\n".join(words * 3).upper()).tolist() == alone * 3
    many = [b"%d" % i for i in range(40_000)]
    assert len(np.unique(module._word_hashes(b" ".join(many)))) == len(many)
    assert len(module.shingle_set(b" ".join(many + many))) == len(many) and len(module.shingle_set(b" \n")) == 0


def test_texts_that_are_not_asked_for_do_not_move(spark, monkeypatch):
    texts = module._keyed(documents(spark, [(i, f"text {i}") for i in range(5000)])).drop("doc_id")
    keys = texts.filter(F.substring("text", -2, 2) == "07").select("k1", "k2")
    got = {r.text for r in module._among(texts, keys).collect()}
    assert {f"text {i}" for i in range(107, 5000, 100)} <= got and len(got) < 600
    assert module._among(texts, keys.filter("false")).count() < 5000
    monkeypatch.setattr(module, "MOST_KEYS", 48)
    assert module._among(texts, keys).count() == 5000
