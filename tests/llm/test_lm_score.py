import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from corpusloom.llm.lattice import Lattice, read_vocabulary
from corpusloom.llm.lm_score import default_vocabulary, score_documents
from tests.llm.helpers import F, documents, nearly, rows


def every_segmentation(text, logp):
    if not text:
        return 1.0
    return sum(math.exp(p) * every_segmentation(text[len(w) :], logp) for w, p in logp.items() if text.startswith(w))


def small_lattice():
    pieces = [b" ", b"a", b"b", b" a", b"ab", b"aba", b"bb", b" ab"]
    weights = np.array([1, 2, 2, 3, 4, 1, 2, 3.0])
    return pieces, np.log(weights / weights.sum())


def test_marginal_equals_the_sum_over_all_segmentations():
    pieces, logp = small_lattice()
    lattice = Lattice.of(pieces, logp)
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))).encode() for _ in range(80)]
    want = [every_segmentation(b" " + w, dict(zip(pieces, logp))) for w in words]
    assert np.allclose(np.exp(lattice.likelihoods(words)[:, 0]), want)
    assert np.allclose([lattice._one(b" " + w, None, None)[0] for w in words], np.log(want))


def test_pieces_of_any_length_are_edges():
    """Pieces of up to 40 bytes, two with one head: every segmentation counts, in short words and in those that go one by one; so do expected uses."""
    pieces = [b" ", b"a", b"b", b" a", b"ab" * 8, b"ab" * 8 + b"a", b"ab" * 10, b"ab" * 10 + b"b" * 20, b" " + b"ab" * 9]
    logp = np.log(np.arange(1, len(pieces) + 1) / sum(range(len(pieces) + 1)))
    lattice = Lattice.of(pieces, logp)
    words = [b"ab" * 8, b"ab" * 9, b"b" + b"ab" * 10, b"ab" * 10 + b"b" * 20, b"ab" * 12 + b"b" * 3, b"ab" * 10 + b"b" * 19, b"ab" * 10 + b"b" * 40]

    def marginal(text):  # by position, as there are many segmentations
        reach = [1.0] + [0.0] * len(text)
        for i in range(len(text)):
            for p, x in zip(pieces, logp, strict=True):
                if text.startswith(p, i):
                    reach[i + len(p)] += reach[i] * math.exp(x)
        return math.log(reach[-1])

    want = [marginal(b" " + w) for w in words]
    assert np.allclose(lattice.likelihoods(words)[:, 0], want)
    assert np.allclose([lattice._one(b" " + w, None, None)[0] for w in words], want)
    counts, both = np.ones((len(words), 1)), [np.zeros((1, len(pieces))) for _ in range(2)]
    lattice.likelihoods(words, counts, both[0])
    for w in words:
        lattice._one(b" " + w, np.ones(1), both[1])
    assert np.allclose(*both) and (both[0][0, 4:] > 0).all()


def test_every_piece_that_a_text_can_hold_is_in_the_lattice():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=default_vocabulary())
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    held = {p for p in (model.id_to_piece(i).replace("\u2581", " ").encode() for i in plain) if p == p.lower() and b" " not in p[1:]}
    vocabulary = read_vocabulary(default_vocabulary())
    assert held <= vocabulary.keys() and max(map(len, held)) > 16


def test_expected_uses_are_posteriors():
    pieces, logp = small_lattice()
    lattice = Lattice.of(pieces, logp)
    words = [b"ab", b"abb", b"baab"]
    counts = np.array([[1.0], [2.0], [3.0]])
    expected = np.zeros((1, len(pieces)))
    lattice.likelihoods(words, counts, expected)

    def paths(text):
        if not text:
            yield ()
        for i, p in enumerate(pieces):
            if text.startswith(p):
                for rest in paths(text[len(p) :]):
                    yield (i, *rest)

    want = np.zeros(len(pieces))
    for w, c in zip(words, counts[:, 0]):
        found = list(paths(b" " + w))
        weight = np.array([math.exp(sum(logp[i] for i in p)) for p in found])
        for p, x in zip(found, weight / weight.sum()):
            for i in p:
                want[i] += x * c
    assert np.allclose(expected[0], want)
    single = np.zeros((1, len(pieces)))
    for w, c in zip(words, counts):
        lattice._one(b" " + w, c, single)
    assert np.allclose(single, expected)


def test_every_piece_is_found_and_long_words_are_finite():
    weights = read_vocabulary(default_vocabulary())
    lattice = Lattice.of(list(weights), np.log(np.array(list(weights.values()))))
    assert (lattice.numbers(lattice.codes) == np.arange(len(weights))).all()
    assert np.isfinite(lattice.likelihoods([b"x" * 3000, bytes(range(128, 256)), b"the"])).all()


def corpus():
    rng = random.Random(4)
    parts = {"en": ["the", "on", "re", "st"], "fr": ["eau", "le", "é", "qu"]}
    texts = []
    for i in range(120):
        lang = "en" if i % 3 else "fr"
        texts.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(0, 40))), lang))
    return [*texts, (120, None, None), (121, "", "en"), (122, "The THE\tthe\x0b\n", "fr")]


def test_base_score_and_counts_follow_the_definition(spark):
    texts = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    split = {d: re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or "")) + ["</end>"] for d, t, _ in texts}
    out = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in split}
    c = Counter(w for d in split if not out[d] for w in split[d])
    n, v = sum(c.values()), len(c)
    by_head = [{r.doc_id: r for r in score_documents(docs, head=h).collect()} for h in (5, 1000)]
    for got in by_head:
        assert len(got) == len(texts)
        for d, words in split.items():
            r = got[d]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[d], len(words), sum(c[w] > 0 for w in words), n)
            assert nearly(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
    for d in split:
        assert nearly(by_head[0][d].score, by_head[1][d].score)  # joined or at hand, the same
    held = [d for d in split if out[d]]
    assert sum(by_head[0][d].score for d in held) > sum(by_head[0][d].base_score for d in held)


def test_edge_tables(spark):
    assert rows(score_documents(documents(spark, []))) == []
    only = score_documents(documents(spark, [(None, "a b"), (None, None)]), folds=1, fold=0).collect()  # all is held out
    assert all(r.held_out and math.isfinite(r.score) and r.n_known == 0 and r.train_tokens == 0 for r in only)


def test_a_long_token_is_scored_with_a_few_columns():
    lattice = Lattice.of([b" ", b"a", b"b", b"ab", b" a"], np.log(np.array([0.2, 0.2, 0.2, 0.2, 0.2])))
    for n in (20, 5000):
        word = b"ab" * (n // 2)
        whole = lattice._one(b" " + word, np.ones(1), np.zeros((1, 5)))
        assert np.allclose(lattice._one(b" " + word, None, None), whole)


def test_most_frequent_words_by_histogram(spark):
    from corpusloom.llm.lm_score import _most_frequent

    counts = spark.createDataFrame([(f"w{i}".encode(), 1000 // (i + 1) + 1) for i in range(500)], "word binary, c0 long")
    got = [r.c0 for r in _most_frequent(counts, F.col("c0"), 50).collect()]
    assert 0 < len(got) <= 50 and min(got) > 1000 // 51
    assert _most_frequent(counts, F.col("c0"), 0).count() == 0 and _most_frequent(counts, F.col("c0"), 500).count() == 500


def test_scores_follow_from_the_model_by_hand(spark):
    """The word edge, the mixture over classes and the final sum, and the plain marginal."""
    from corpusloom.llm.lm_score import fit_lattice

    texts = corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model, counts = fit_lattice(docs)
    classes = len(model.documents)
    uses = {bytes(r.word): [r[f"c{k}"] for k in range(classes)] for r in counts.collect()}
    weights = read_vocabulary(default_vocabulary())
    total = sum(weights.values())
    plain = Lattice.of(list(weights), np.log(np.array(list(weights.values())) / total))
    got = {r.doc_id: r for r in score_documents(docs, head=20).collect()}
    share = [d / model.documents.sum() for d in model.documents]
    for d, text, _ in texts:
        words = (text or "").encode().lower().split()
        logs = [math.log10(share[k]) + math.log10(model.documents[k] / (model.tokens[k] + model.types[k])) for k in range(classes)]
        for w in words:
            own = np.exp(model.lattice.likelihoods([w])[0])
            for k in range(classes):
                logs[k] += math.log10((uses.get(w, [0] * classes)[k] + model.types[k] * own[k]) / (model.tokens[k] + model.types[k]))
        top = max(logs)
        assert nearly(got[d].score, top + math.log10(sum(10 ** (x - top) for x in logs)))
        assert nearly(got[d].lattice_score, sum(float(plain.likelihoods([w])[0, 0]) for w in words) / math.log(10))
