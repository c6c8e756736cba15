"""Very long texts, whole: what stands at their end counts as what stands at their beginning."""

import random
import zlib

from corpusloom.llm.mixing import mix
from corpusloom.llm.sharding import shard_documents
from corpusloom.llm.simhash import simhash_groups
from corpusloom.llm.toxicity import classify_toxicity
from tests.llm.helpers import documents
from tests.llm.test_classifiers import labels, prose
from tests.llm.test_simhash import brute_print

LONG = "the river runs over grey stones " * 50_000


def test_mixing(spark):
    docs = documents(spark, [(1, LONG), (2, LONG + " more"), (3, "few words"), (4, "x" * 2_000_000)])
    got = {r.doc_id: r for r in mix(docs).collect()}
    assert [got[i].size for i in (1, 2, 3, 4)] == [300_000, 300_001, 2, 1]
    assert sum(r.taken for r in got.values()) == int(got[1].target) and all(r.taken <= 2 * r.size for r in got.values())


def test_sharding(spark):
    texts = {1: LONG, 2: LONG + "é", 3: ""}
    for r in shard_documents(documents(spark, list(texts.items())), 8).collect():
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


def test_toxicity(spark):
    """A long document with many toxic words at its very end only, and the same without them."""
    rng, texts, truth = random.Random(8), [], []
    vile = ["vilest", "grubberly", "grubberish", "snorfling"]
    for i in range(600):
        words = prose(rng, 60).split()
        if i % 4 == 0:
            words[rng.randrange(60)] = rng.choice(vile)
        texts.append((i, " ".join(words)))
        truth.append((i, 1, int(i % 4 == 0)))
    texts += [(1000, LONG + " ".join(vile)), (1001, LONG)]
    got = {r.doc_id: r for r in classify_toxicity(documents(spark, texts), labels(spark, truth)).collect()}
    assert got[1000].predicted == 1 and got[1001].predicted == 0 and 0 <= got[1001].score < 0.5 <= got[1000].score <= 1


def test_simhash(spark):
    """60,000 shingles, more than are counted at once; copies that differ at the end."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(3000)}" for _ in range(60_000)]
    texts = [" ".join(words), " ".join(words[:-1] + ["END"]), " ".join(rng.sample(words, 60_000))]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_groups(documents(spark, list(enumerate(texts)))).collect()}
    assert {i: f for i, (f, _) in got.items()} == {i: f"{brute_print(t):016x}" for i, t in enumerate(texts)}
    assert got[0][1] == got[1][1] == 0 and got[2][1] == 2
