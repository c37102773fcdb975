from __future__ import annotations

import random

import numpy as np
from tests.llm.conftest import prose

from revisit.llm import toxicity as tx

SMALL = tx.Shape(window=12, step=6, max_docs=150, epochs=20, texts_a_step=12)


def sample(n, seed):
    rng, texts, labels = random.Random(seed), [], []
    for i in range(n):
        words = prose(seed * 1000 + i, rng.randint(10, 80)).split(" ")
        bad = rng.random() < 0.4
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["dunderhead", "Nitwit!", "blockhead,"])
        texts.append(" ".join(words))
        labels.append(float(bad))
    return texts, np.array(labels)


def test_gradients_match_differences():
    s = tx.Shape(hidden=4, window=5, step=2, word_size=3, gram_size=3, attention=3)
    net = tx.Network(s)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, mask, y = rng.standard_normal((6, 5, 6)), np.ones((6, 5)), np.array([1, 0, 1, 0, 1, 0.0])
    mask[0, 3:], mask[2, 1:], mask[4] = 0, 0, 0

    def loss():
        logit = net.logits(*net.gates(x), mask)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    grads, _ = net.gradients(x, mask, y)
    for name, g in grads.items():
        flat = net.p[name].reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - g.reshape(-1)[i]) < 1e-4, name


def test_windows_overlap_and_cover():
    for n in range(0, 200):
        at = tx.windows(n, SMALL)
        seen = {i for a in at for i in range(a, a + SMALL.window)}
        assert set(range(n)) <= seen and len(at) >= 1
        assert (np.diff(at) == SMALL.step).all() and (len(at) == 1 or at[-1] < n)


def test_a_passage_of_half_a_window_lies_whole_in_one():
    s = tx.Shape()
    for n in (17, 33, 60, 300):
        at = tx.windows(n, s)
        assert all(any(a <= p and p + 17 <= a + s.window for a in at) for p in range(n - 16))


def test_learns_and_finds_the_word_anywhere():
    texts, labels = sample(300, 1)
    net = tx.train(texts, labels, SMALL)
    held, marks = sample(150, 2)
    score = tx.Scorer(net)
    assert ((score(held) >= 0.5) == marks).mean() > 0.93
    long = prose(77, 3000)
    clean, bad = score([long, long + " you nitwit! " + prose(78, 50)])
    assert bad > 0.7 and bad > clean


def test_one_scorer_or_another_score_alike():
    texts, labels = sample(60, 3)
    net = tx.train(texts, labels, SMALL)
    assert np.allclose(tx.Scorer(net, most=50)(texts), tx.Scorer(net)(texts), atol=1e-5)


def test_every_document_is_scored(docs, clashing, none):
    texts, labels = sample(40, 4)
    net = tx.train(texts, labels, SMALL)
    want = sorted(zip([str(r["doc_id"]) for r in docs.collect()], tx.Scorer(net)([r["text"] for r in docs.collect()])))
    for some in (docs, clashing):
        got = sorted((str(r["doc_id"]), r["score"]) for r in tx.scored(some, net).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-5) and all(0 <= g[1] <= 1 for g in got)
    assert tx.scored(none, net).collect() == []


def test_without_both_labels_scores_are_constant(spark, docs):
    labels = spark.createDataFrame([(0, 1), (4, None), (None, 0)], "doc_id long, label int")
    texts, marks = tx.training_texts(docs, labels, SMALL)
    score = tx.Scorer(tx.train(texts, marks, SMALL))
    assert len(texts) == 1 and len(set(score(["a", None, "b c"]).tolist())) == 1
    assert tx.Scorer(tx.train([], np.array([]), SMALL))(["a"])[0] == 0.5


def test_the_scorer_gives_the_networks_logits():
    """The scorer's passes, place by place, against the network's own, over all windows of each text."""
    texts, labels = sample(60, 5)
    net = tx.train(texts, labels, SMALL)
    some = [*texts[:20], prose(9, 500), "x", None, " "]
    want = []
    for text in some:
        words = tx.tokens(text)
        word, grams = zip(*(tx.codes(w, SMALL) for w in words)) if words else ((), ())
        x = np.zeros((len(words) + 1, SMALL.word_size + SMALL.gram_size), np.float32)
        if words:
            x[:-1] = net.inputs(np.array(word), list(grams))
        at, mask, _ = tx._layout(np.array([len(words)]), SMALL)
        want.append(net.logits(*(g[np.where(at >= 0, at, len(words))] for g in net.gates(x)), mask).max())
    assert np.allclose(tx.Scorer(net).raw(some), want, atol=1e-4)


def test_the_sample_is_bounded_and_one_text_an_id(spark):
    rows = [(i % 40, f"text {i} " * (300 if i % 7 == 0 else 1), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    s = tx.Shape(max_docs=9, max_chars=500)
    texts, marks = tx.training_texts(docs, labels, s)
    assert len(texts) == len(marks) <= 18 and marks.tolist() == sorted(marks.tolist()) and all(len(t) <= 500 for t in texts)
    ids = [int(t.split()[1]) % 40 for t in texts]
    assert len(set(ids)) == len(ids) and all(i % 2 == y for i, y in zip(ids, marks))
