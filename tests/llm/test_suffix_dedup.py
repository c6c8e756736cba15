import hashlib
import random

import pytest

from corpusloom.llm import suffix_dedup as module
from corpusloom.llm.suffix_dedup import picks, suffix_dedup
from corpusloom.llm.suffix_sort import two_stage_order
from tests.llm.helpers import documents, rows


def brute(docs, width=100):
    first, out = {}, {}
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            if w in first:
                gone[s : s + width] = b"\1" * width
            else:
                first[w] = s
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    syllables = "the on re st ing er ly nd tion ou é zu ".split(" ")
    say = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    passages = [say(rng.choice([20, 40, 50, 80, 200])) for _ in range(12)] + ["ab" * 90, "x" * 300, say(40) * 5]
    docs = []
    for d in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else say(rng.randrange(0, 90)) for _ in range(rng.randrange(0, 5))]
        docs.append((d * 3, "".join(parts)))
        if rng.random() < 0.2 and docs:
            text = rng.choice(docs)[1]
            at = rng.randrange(len(text) + 1)
            docs.append((d * 3 + 1, text[:at] + "#" + text[at:]))
    return docs


def test_order_and_common_prefixes():
    rng = random.Random(1)
    for turn in range(120):
        strings = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(5, 40))) for _ in range(rng.randrange(1, 8))]
        if turn % 5 == 0:
            strings = [b"a" * rng.randrange(5, 30) for _ in range(4)]
        windows, depth = [rng.randrange(1, len(s) - 3) for s in strings], rng.choice([3, 5, 50])
        owner, offset, common = two_stage_order(strings, windows, depth)
        suffixes = [strings[a][b : b + depth] for a, b in zip(owner, offset)]
        assert suffixes == sorted(suffixes)
        assert sorted(zip(owner.tolist(), offset.tolist())) == [(a, b) for a in range(len(strings)) for b in range(windows[a])]
        for k in range(1, len(suffixes)):
            a, b = suffixes[k - 1], suffixes[k]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == same


def test_equal_windows_have_equal_picks():
    texts = [t.encode() for _, t in corpus(3, 40) if len(t.encode()) >= 100]
    number, first, length, pick = picks(texts)
    at: dict[bytes, int] = {}
    seen = 0
    for i, a, n, h in zip(number.tolist(), first.tolist(), length.tolist(), pick.tolist()):
        for s in range(a, a + n):
            assert at.setdefault(texts[i][s : s + 100], h) == h
            seen += 1
    assert seen == sum(len(t) - 99 for t in texts)


@pytest.mark.parametrize("often", [64, 2])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, often):
    monkeypatch.setattr(module, "OFTEN", often)
    monkeypatch.setattr(module, "PIECE", 2000)
    docs = [*corpus(8, 60), (900, None), (901, ""), (902, "z" * 99), (903, "z" * 100), (904, "z" * 101)]
    random.Random(2).shuffle(docs)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup(documents(spark, docs).repartition(5)).collect()}
    assert got == brute(docs)


def test_shared_and_missing_ids(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(260))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = rows(suffix_dedup(documents(spark, [(None, text), (1, text), (1, text), (1, "no " + text), (2, "short")])))
    assert (None, 260, 0, 0, digest(text)) in got and (2, 5, 0, 0, digest("short")) in got
    assert got.count((1, 260, 260, 1, digest(""))) == 2 and (1, 263, 260, 1, digest("no ")) in got
    assert rows(suffix_dedup(documents(spark, []))) == []
