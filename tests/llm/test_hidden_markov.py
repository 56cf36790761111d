from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tariffloom.llm import hidden_markov as hm


def base_scores(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 10:
            counts.update((t or "").encode().lower().split() + [hm.END])
    total, distinct = sum(counts.values()), len(counts)
    for i, t in rows:
        words = (t or "").encode().lower().split() + [hm.END]
        yield (i, zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0, len(words), sum(counts[w] > 0 for w in words), total,
               sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words))


def test_base_and_scores(spark, odd, odd_texts, none, monkeypatch):
    got = hm.scores(odd, rounds=2).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for mine, want in zip(rows, sorted(base_scores(odd_texts), key=key), strict=True):
        assert mine[:5] == want[:5] and abs(mine[5] - want[5]) < 1e-6
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert hm.scores(none).count() == 0
    # words that don't travel with the model are looked up, with the same result
    monkeypatch.setattr(hm, "FREQUENT", 40)
    again = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in hm.scores(odd, rounds=1).collect()), key=key)
    assert all(a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 for a, b in zip(again, rows, strict=True))


def small_model(states=3, classes=5):
    rng = np.random.default_rng(4)
    share = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(shape) + 0.1)
    return hm.Model(share(states), share(states, states), share(states, classes))


def test_likelihood_is_the_sum_over_all_paths():
    model = small_model()
    seqs = [np.array(s, np.uint16) for s in ([0], [1, 4, 2], [3, 3, 3, 0, 1], [2, 2])]
    for seq, got in zip(seqs, hm.likelihoods(seqs, model)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * model.emit[path[0], seq[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.emit[path[t], seq[t]]
            total += p
        assert abs(got - math.log10(total)) < 1e-12


@pytest.mark.parametrize("piece", [1, 2, 3, 512])
def test_expected_counts_against_all_paths(monkeypatch, piece):
    monkeypatch.setattr(hm, "PIECE", piece)
    model = small_model()
    seqs = [np.array(s, np.uint16) for s in ([1, 4, 2], [3, 0, 3, 1], [2])]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for seq in seqs:
        paths = list(itertools.product(range(3), repeat=len(seq)))
        weight = np.array([model.start[p[0]] * model.emit[p[0], seq[0]] * math.prod(
            model.move[p[t - 1], p[t]] * model.emit[p[t], seq[t]] for t in range(1, len(seq))) for p in paths])
        for p, w in zip(paths, weight / weight.sum()):
            start[p[0]] += w
            for t, s in enumerate(p):
                emit[s, seq[t]] += w
                if t:
                    move[p[t - 1], s] += w
    got = hm.unpacked(hm.expected_counts(seqs, model), 3)
    for a, b in zip(got, (start, move, emit)):
        assert np.allclose(a, b)


def test_a_long_text_trains_as_one_sequence(monkeypatch):
    monkeypatch.setattr(hm, "KEPT", 2)  # earlier pieces are run through again on the way back
    rng = np.random.default_rng(8)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (2000, 513, 512, 511, 1536, 1, 2000, 1024)]
    cut = hm.unpacked(hm.expected_counts(seqs, small_model()), 3)
    monkeypatch.setattr(hm, "PIECE", 4096)
    whole = hm.unpacked(hm.expected_counts(seqs, small_model()), 3)
    assert all(np.allclose(a, b) for a, b in zip(cut, whole))
    start, move, emit = cut
    assert abs(start.sum() - len(seqs)) < 1e-6  # one start a text, and every other token is moved to
    assert abs(move.sum() - sum(len(s) - 1 for s in seqs)) < 1e-6 and abs(emit.sum() - sum(map(len, seqs))) < 1e-6


def test_own_words_are_ranked_apart_from_the_bins(spark, monkeypatch):
    """Words of one count: more than are looked up at once, and yet ``OWN`` of them have a class."""
    flat = spark.range(3000).selectExpr("cast(lpad(id, 5, 'w') as binary) as word", "5L as n")
    counts = flat.unionByName(spark.createDataFrame([(bytearray(hm.END), 900), (bytearray(b"x" * 40), 700)], flat.schema))
    monkeypatch.setattr(hm, "FREQUENT", 1000)
    vocab = hm.vocabulary(counts)
    assert len(vocab.own) == hm.OWN + 1 and set(vocab.frequent) == set(vocab.own)
    want = sorted(str(i).rjust(5, "w").encode() for i in range(3000))[:hm.OWN]
    assert [w for w in vocab.own if w != hm.END] == want
    assert vocab.class_tokens.sum() == 3000 * 5 + 900 + 700 and vocab.class_tokens.min() >= 0


def test_training_never_loses_likelihood():
    rng = np.random.default_rng(6)
    seqs = [rng.integers(0, 5, rng.integers(1, 40)).astype(np.uint16) for _ in range(30)]
    model, before = small_model(), -math.inf
    for _ in range(6):
        now = hm.likelihoods(seqs, model).sum()
        assert now >= before - 0.5  # smoothing may cost a little
        before, model = now, hm.Model.of_counts(hm.expected_counts(seqs, model), 3)


def test_words_within_a_class_sum_to_one(spark, odd):
    counts = hm.word_counts(odd.select("text"))
    vocab = hm.vocabulary(counts)
    by_class = Counter()
    for r in counts.collect():
        word = bytes(r.word)
        if word not in vocab.own:
            by_class[hm.ending(word)] += (r.n + hm.D) / (vocab.class_tokens[hm.ending(word)] + hm.D * (vocab.class_words[hm.ending(word)] + 1))
    for k in range(hm.OWN, hm.OWN + hm.ENDINGS):
        unknown = hm.D / (vocab.class_tokens[k] + hm.D * (vocab.class_words[k] + 1))
        assert abs(by_class[k] + unknown - 1) < 1e-9
