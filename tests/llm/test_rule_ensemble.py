from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F
from tests.llm.conftest import prose

from revisit.llm import rule_ensemble as re_


def brute(text):
    t = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", t), [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    spaces = len(re.findall(r"[\x20\x09-\x0D]", t))
    n, c = len(words), len(t)
    symbols, plain = len(re.findall(r"[#*$%&|<>]", t)), len(re.findall("[a-z]", t))
    return {
        "n_words": n, "n_chars": c, "word_length": (c - spaces) / n if n else 0, "symbols": symbols / c if c else 0, "lower": plain / c if c else 0, "spaces": spaces / c if c else 0,
        "dup_lines": (len(lines) - len(set(lines))) / len(lines) if lines else 0, "line_words": n / len(lines) if lines else 0, "distinct_words": len(set(words)) / n if n else 0,
    }


def test_statistics(clashing):
    for r in re_.statistics(clashing).select("text", "features").collect():
        got = dict(zip(re_.FEATURES, r["features"]))
        for name, x in brute(r["text"]).items():
            assert abs(got[name] - x) < 1e-12, (name, r["text"])


def data(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 5))
    p = np.where((x[:, 0] > 0.7) & (x[:, 1] <= 0.4), 0.95, np.where(x[:, 2] > 0.9, 0.8, 0.05))
    return x, (rng.random(n) < p).astype(float)


def test_few_rules_find_the_conjunction():
    x, y = data()
    model = re_.fit(x, y, re_.Training(trees=40, lasso=0.02))
    assert 1 <= len(model.rules) <= 40 and all(1 <= len(r) <= 6 for r in model.rules)
    new, want = data(seed=1)
    assert ((model(new) > 0.5) == want).mean() > 0.9


def test_the_column_is_the_model(spark):
    x, y = data(400)
    model = re_.fit(x, y, re_.Training(trees=15))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, f array<double>")
    got = [r["s"] for r in rows.select("i", model.column(F.col("f")).alias("s")).orderBy("i").collect()]
    assert np.allclose(got, model(x), atol=1e-12)


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(2)
    r, t = (rng.random((500, 12)) < 0.3).astype(float), re_.Training(lasso=0.01, steps=5000)
    y = (rng.random(500) < 1 / (1 + np.exp(-(3 * r[:, 0] - 2 * r[:, 1])))).astype(float)
    w, b = re_.lasso_logistic(r, y, t)
    gradient = ((1 / (1 + np.exp(-(r @ w + b))) - y) @ (r - r.mean(0))) / 500 / np.sqrt(r.mean(0) * (1 - r.mean(0)))
    assert (np.abs(gradient) <= 0.01 + 1e-4).all() and (w == 0).sum() >= 5 and abs(w[0] - 3) < 1.2
    assert np.allclose(np.abs(gradient[w != 0]), 0.01, atol=1e-4)


def test_labels_are_bounded_and_cleaned(spark):
    counted = spark.createDataFrame([(i, [float(i)]) for i in range(20)] + [(None, [0.0])], "doc_id long, features array<double>")
    labels = spark.createDataFrame([(i, 1) for i in range(10)] + [(3, 0), (3, 0), (4, None), (None, 1)], "doc_id long, label int")
    x, y = re_.training_rows(counted, labels, re_.Training(max_rows=100))
    assert dict(zip(x[:, 0], y)) == {float(i): float(i != 3) for i in range(10)}
    assert len(re_.training_rows(counted, labels, re_.Training(max_rows=4))[1]) == 4


def test_one_kind_of_label_or_none():
    assert len(set(re_.fit(np.random.rand(9, 3), np.ones(9))(np.random.rand(5, 3)))) == 1
    assert re_.fit(np.zeros((0, 3)), np.zeros(0))(np.zeros((1, 3)))[0] == 0.5


def test_empty_table(none):
    assert re_.statistics(none).collect() == []


def test_prose_against_symbols(spark):
    good = [prose(i, 100) for i in range(60)]
    bad = [" ".join(w + "***" for w in t.split()) for t in good]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    counted = re_.statistics(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id")
    x = np.array([r["features"] for r in counted.collect()])
    y = np.array([1.0] * 60 + [0.0] * 60)
    model = re_.fit(x[::2], y[::2])
    assert ((model(x[1::2]) > 0.5) == y[1::2]).all()
