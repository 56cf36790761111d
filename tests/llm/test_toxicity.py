from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np

from tariffloom.llm import toxicity
from tariffloom.llm.boosting import best_split, calibrated, fit_isotonic, fit_trees, sigmoid
from tariffloom.llm.queries import op10_toxicity


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = fit_trees(x[:1500], y[:1500])
    assert ((sigmoid(model.margin(x[1500:])) > 0.5) == y[1500:]).mean() > 0.95
    assert fit_trees(x[:0], y[:0]).margin(x[:2]).tolist() == [0, 0]


def test_isotonic_is_monotone_and_fits():
    rng = np.random.default_rng(2)
    margin = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < sigmoid(margin)).astype(float)
    grid = np.linspace(-5, 5, 200)
    got = calibrated(grid, fit_isotonic(margin, y))
    assert (np.diff(got) >= 0).all() and np.abs(got - sigmoid(grid))[40:160].max() < 0.12
    assert calibrated(np.zeros(1), fit_isotonic(margin[:0], y[:0])) == [0.5]
    assert 0 < calibrated(np.zeros(1), fit_isotonic(np.zeros(9), np.zeros(9)))[0] < 0.5


def test_held_out_accuracy_on_planted_words(spark):
    rng = random.Random(3)
    syllables = ["ba", "do", "ki", "lu", "me", "ra", "so", "ti"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    bad = ["grunx", "vlompf", "zweck"]
    rows, marks = [], []
    for k in range(1500):
        toxic = k % 7 == 0
        text = [word() for _ in range(rng.randint(5, 120))]
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", "o", "ti", "."]))
        rows.append((k, " ".join(text)))
        marks.append((k, 1, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    held = [k for k in scores if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(scores[k] >= 0.5) == (k % 7 == 0) for k in held]) > 0.98
    assert all(0 <= s <= 1 for s in scores.values())
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {k for k, s in scores.items() if s < 0.5}


def test_odd_and_empty_tables(odd, odd_texts, none, labels):
    model = toxicity.train(odd, labels)
    assert toxicity.scored(odd, model).count() == len(odd_texts)
    assert toxicity.without_toxic(odd, model, 2.0).exceptAll(odd).count() == 0
    assert toxicity.scored(none, model).count() == 0 and toxicity.without_toxic(none, model).count() == 0
    blank = toxicity.train(none, labels.limit(0))
    assert {r.score for r in toxicity.scored(odd, blank).collect()} == {0.5}


def test_best_split_is_the_best_of_all_cuts():
    rng = np.random.default_rng(5)
    for _ in range(100):
        n, edges = int(rng.integers(2, 25)), [np.arange(int(rng.integers(0, 6))) for _ in range(3)]
        binned = np.stack([rng.integers(0, len(e) + 1, n) for e in edges], 1)
        grad, hess = rng.normal(0, 1, n), rng.random(n)
        gains = {}
        for f, e in enumerate(edges):
            for k in range(len(e)):
                left = binned[:, f] <= k
                if hess[left].sum() >= 0.5 and hess[~left].sum() >= 0.5:
                    part = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1.0)
                    gains[f, k] = part(left) + part(~left) - part(np.ones(n, bool))
        best = max(gains.values(), default=0)
        found = best_split(binned, grad, hess, edges, 1.0, 0.5)
        assert (found is None and best <= 1e-9) or abs(gains[found] - best) < 1e-9


def test_isotonic_map_is_the_least_squares_one():
    """At every margin: the largest of the smallest means of neighbouring rows (the max-min formula), equal margins together."""
    rng = np.random.default_rng(6)
    for _ in range(100):
        n = int(rng.integers(1, 12))
        margin, y = rng.integers(-4, 5, n).astype(float), rng.integers(0, 2, n).astype(float)
        points = sorted([*zip(margin, y), (margin.min(), 0.5), (margin.max(), 0.5)])
        places = sorted(set(margin))
        sums = [(sum(v for m, v in points if m == p), sum(m == p for m, _ in points)) for p in places]
        mean = lambda a, b: sum(s for s, _ in sums[a:b + 1]) / sum(w for _, w in sums[a:b + 1])
        want = [max(min(mean(a, b) for b in range(i, len(places))) for a in range(i + 1)) for i in range(len(places))]
        assert np.allclose(calibrated(np.array(places), fit_isotonic(margin, y)), want)


def test_columns_of_the_query_on_odd_rows(spark, odd, odd_texts, labels, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = op10_toxicity(spark, str(tmp_path)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    assert Counter((r.doc_id, r.held_out) for r in rows) == Counter((i, held(i)) for i, _ in odd_texts)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    # equal texts score alike, whatever their ids
    scores = {}
    for r in rows:
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert scores[1] == scores[2] and len(scores[8] | scores[9]) == 1
