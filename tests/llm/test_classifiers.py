import random

import numpy as np
import pytest

from corpusloom.llm.labelled import at_most
from corpusloom.llm.quality import N_STATISTICS, classify_quality, fourier, isotonic, statistics, without_rejected
from corpusloom.llm.toxicity import classify_toxicity, fit_toxicity, swapped, words_of
from tests.llm.helpers import F, documents, rows

WORDS = "the river runs over stones and trees while people walk slowly under the grey morning sky of town".split()


def prose(rng, n=40):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def labels(spark, triples):
    return spark.createDataFrame(triples, "doc_id long, quality int, toxic int")


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x, y = rng.normal(size=30), rng.integers(0, 2, 30).astype(float)
        knots, levels = isotonic(x, y)
        assert (np.diff(levels) > 0).all() and (np.diff(knots) >= 0).all()
        order = np.argsort(x)
        best = [max(min(y[order][a:b].mean() for b in range(i + 1, 31)) for a in range(i + 1)) for i in range(30)]
        assert np.allclose(sorted(set(np.round(best, 12))), levels)


def test_features_approximate_a_gaussian_kernel():
    z = np.random.default_rng(2).normal(size=(60, N_STATISTICS)) / 2
    phi = fourier(z)[:, :-1]
    want = np.exp(-((z[:, None] - z[None]) ** 2).sum(-1) / (2 * N_STATISTICS))
    assert np.abs(phi @ phi.T - want).max() < 0.2


def test_statistics_of_odd_texts():
    out = statistics([b"", b" \n ", b"x", b"!" * 100000, "é".encode() * 50])
    assert out.shape == (5, N_STATISTICS) and np.isfinite(out).all() and not out[:2].any()


def test_quality_on_held_out_rows(spark):
    rng = random.Random(3)
    texts, truth = [], []
    for i in range(900):
        good = i % 4 > 0
        texts.append((i, prose(rng) if good else " ".join(w + rng.choice(["***", "%%%", "###"]) for w in prose(rng).split())))
        truth.append((i, int(good), 0))
    docs = documents(spark, [*texts, (900, None), (901, "")])
    out = {r.doc_id: r for r in classify_quality(docs, labels(spark, truth)).collect()}
    held = [(out[i], q) for i, q, _ in truth if out[i].held_out]
    assert len(held) > 200 and np.mean([r.predicted == q for r, q in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    kept = without_rejected(docs, labels(spark, truth))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.predicted}


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    texts, truth = [], []
    for i in range(900):
        words = prose(rng, 80).split()
        if i % 5 == 0:
            words[rng.randrange(80)] = rng.choice(["vilest", "GRUBBERLY,", "grubberish", "snorfling"])
        texts.append((i, " ".join(words)))
        truth.append((i, 1, int(i % 5 == 0)))
    out = {r.doc_id: r for r in classify_toxicity(documents(spark, texts), labels(spark, truth), folds=7, fold=0).collect()}
    held = [(out[i], t) for i, _, t in truth if out[i].held_out]
    assert len(held) > 80 and np.mean([r.predicted == t for r, t in held]) > 0.97


@pytest.mark.parametrize("penalty", [0.0, 100.0])
def test_counterfactuals_take_the_weight_off_mentions(spark, penalty):
    rng = random.Random(5)
    texts, truth = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = prose(rng, 30).split()
        if rng.random() < (0.9 if toxic else 0.05):  # mentions go with toxic texts in this sample
            words[3] = rng.choice(["muslim", "muslims"])
        if toxic and rng.random() < 0.7:
            words[7] = "vilest"
        texts.append((i, " ".join(words)))
        truth.append((i, 1, int(toxic)))
    model = fit_toxicity(documents(spark, texts), labels(spark, truth), folds=1000, fold=999, counterfactual=penalty)
    plain = words_of(b"the muslim people walk slowly under the sky")
    gap = abs(model.logit(plain) - model.logit(swapped(plain)))
    assert gap > 1 if penalty == 0 else gap < 0.2
    assert model.score(b"the vilest town") > 0.5


def test_samples_stay_within_the_bound(spark):
    rows_ = spark.range(50_000).select(F.col("id").alias("doc_id"))
    for most in (100, 20_000, 60_000):
        n = at_most(rows_, F.xxhash64("doc_id"), most).count()
        assert n <= most and n >= min(50_000, most) * 0.9


def test_edge_tables(spark):
    none = labels(spark, [(None, 1, 1), (1, None, None)])
    docs = documents(spark, [(None, "a"), (1, None), (1, None)])
    assert [r[2:] for r in rows(classify_quality(docs, none))] == [(0.5, 1)] * 3
    assert [r[2:] for r in rows(classify_toxicity(docs, none))] == [(0.0, 0)] * 3
    assert rows(classify_quality(documents(spark, []), none)) == []
    one = labels(spark, [(i, 1, 0) for i in range(12)])
    docs = documents(spark, [(i, f"text {i}") for i in range(12)])
    assert all(r[3] == 1 for r in rows(classify_quality(docs, one))) and all(r[3] == 0 for r in rows(classify_toxicity(docs, one)))


def test_ties_have_one_level_whatever_their_order():
    from corpusloom.llm.quality import isotonic

    for y in ([0, 0, 1, 1], [1, 1, 0, 0], [1, 0, 1, 0]):
        x, level = isotonic(np.ones(4), np.array(y))
        assert x.tolist() == [1.0] and level.tolist() == [0.5]
    x, level = isotonic(np.array([2.0, 1.0, 1.0, 3.0]), np.array([0, 1, 0, 1]))
    assert level.tolist() == sorted(level.tolist()) and level[-1] == 1


def test_identity_terms_are_a_parameter_and_their_rows_are_counted(spark):
    from corpusloom.llm.toxicity import fit_toxicity

    texts = [(i, f"the {'zorg' if i % 3 else 'blip'} went home {'awful' if i % 2 else 'nice'} and {'frau' if i % 4 else 'x'} slept") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    ours = fit_toxicity(documents(spark, texts), labels, identity=[("zorg", "blip")])
    assert ours.counterfactuals == spark.range(200).filter("crc32(cast(id as string)) % 5 <> 0").count()
    german = fit_toxicity(documents(spark, texts), labels)
    assert 0 < german.counterfactuals < ours.counterfactuals
    assert fit_toxicity(documents(spark, texts), labels, identity=[]).counterfactuals == 0


def test_what_a_step_sends_to_the_driver_is_small(spark, monkeypatch):
    from corpusloom.llm import toxicity

    rng = random.Random(6)
    docs = documents(spark, [(i, prose(rng, 30) + (" vilest" if i % 3 == 0 else "")) for i in range(400)]).repartition(40)
    truth, sent, steps = labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(400)]), [], []
    plain = type(docs).toLocalIterator

    def watched(self, *args, **kwargs):
        steps.append(1)
        for r in plain(self, *args, **kwargs):
            sent.append(len(r.sums))
            yield r

    monkeypatch.setattr(type(docs), "toLocalIterator", watched)
    model = fit_toxicity(docs, truth)
    n = len(model.weights)
    assert steps and max(sent) <= 256 << 10 and sum(sent) <= len(steps) * toxicity.TASKS * 8 * (n + n * (n + 1) // 2)
    x = np.random.default_rng(7).normal(size=(50, n))
    hess, grad = x.T @ x, x.sum(0)
    batch = toxicity.sums_sent(grad, hess)
    back = toxicity.sums_read(np.concatenate([np.frombuffer(s) for s in batch.column("sums").to_pylist()]), n)
    assert np.array_equal(back[0], grad) and np.allclose(back[1], hess)
