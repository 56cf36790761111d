"""Importance resampling against plain Python: words by a list, features by slices, ranks by one sort."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from conftest import table

from tariffloom.llm import importance

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, longest=2):
    words = words_of(text)
    return [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, longest=2, buckets=10_000):
    """(doc_id, n_features, weight, score) of each row, and the ranks by score and id."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [[bucket(f) for f in features(t, longest)] for _, t in docs]
    s, t = Counter(b for f in found for b in f), Counter(bucket(f) for x in target for f in features(x, longest))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    rows = []
    for (i, text), f in zip(docs, found, strict=True):
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words_of(text))))
    may = sorted((-r[3], -1e18 if r[0] is None else r[0]) for r in rows if r[4] >= 20)
    return rows, may[:25 * len(may) // 100]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_spans_are_all_runs(longest):
    scan = importance.Scanner(longest)
    for text in ["", " ", "a", "..a--b..", "A bb,ccc\tdddd eeeee", "ÄÖ x9 日本\x00z", "a " * 40_000, "w" * 100_000 + " y"]:
        n, found = scan(text.encode())
        assert n == len(words_of(text))
        assert Counter(found.tolist()) == Counter(zlib.crc32(f.encode()) % 10_000 for f in features(text, longest))


def test_odd_rows(spark, odd, none, odd_texts):
    target = [odd_texts[11][1], None, "", "Some Other words"]
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    rows, drawn = brute(odd_texts, target)
    got = importance.ranked(odd, goal).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got) == Counter(rows)
    assert [(-r.score, -1e18 if r.doc_id is None else r.doc_id) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))
    assert importance.ranked(none, goal).collect() == [] and importance.ranked(odd, goal.limit(0)).count() == len(odd_texts)
    kept = importance.resampled(odd, goal)
    assert kept.columns == odd.columns and kept.exceptAll(odd).count() == 0
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r["rank"]}


def test_ranks_over_many_ties(spark):
    """A third of the rows share id and text, so score and place in the order; ranks are still 1, 2, 3 .."""
    rng = random.Random(2)
    words = [f"w{k}" for k in range(50)]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(10, 40)))) for k in range(400)]
    docs += [(5, "w1 " * 30)] * 200
    rows, drawn = brute(docs, ["w1 w2 w1"])
    got = importance.ranked(table(spark, docs).repartition(6), spark.createDataFrame([(1, "w1 w2 w1")], "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got) == Counter(rows)
    ranks = sorted((r["rank"], -r.score, r.doc_id) for r in got if r["rank"])
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranks] == drawn
