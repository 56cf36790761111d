from __future__ import annotations

import re
from collections import Counter

import numpy as np

from tariffloom.llm import quality


def base(text):
    text = text or ""
    words, seen, dup, covered = re.findall(r"[^\x20\x09-\x0D]+", text), set(), 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    threes = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(threes)
    for i, w in enumerate(threes):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics(spark, odd, odd_texts, none, labels):
    rules = quality.learn(odd, labels)
    rows = quality.judged(odd, rules).collect()
    assert sorted(str((r.doc_id, *(r[c] for c in quality.COUNTS))) for r in rows) == sorted(str((i, *base(t))) for i, t in odd_texts)
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    assert quality.judged(none, quality.learn(none, labels)).count() == 0
    assert quality.learn(odd, labels.limit(0)) == []


def test_covering_finds_planted_rules_and_the_expression_agrees(spark):
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(quality.STATISTICS)))
    a, b, c = (quality.STATISTICS.index(n) for n in ("symbol_rate", "dup_line_rate", "mean_word"))
    bad = (x[:, a] > 0.8) & (x[:, b] > 0.5) | (x[:, c] <= 0.1)
    rules = quality.cover(x, bad)
    inside = np.zeros(len(x), bool)
    for rule in rules:
        inside |= quality.covers(rule, x)
    assert (inside == bad).mean() > 0.97
    table = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[:500])], ["i", *quality.STATISTICS])
    got = {r.i: r.v == "drop" for r in table.select("i", quality.verdict(rules).alias("v")).collect()}
    assert [got[i] for i in range(500)] == inside[:500].tolist()
    assert quality.describe([])[-1] == "otherwise -> keep"


def test_noise_gives_no_rule():
    rng = np.random.default_rng(3)
    assert quality.cover(rng.random((2000, len(quality.STATISTICS))), rng.random(2000) < 0.2) == []
