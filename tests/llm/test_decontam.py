from __future__ import annotations

import random
import re

from tariffloom.llm import common, decontam


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, bench, size=13):
    windows = {}
    for item, text in bench:
        w = words(text)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    for i, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items |= {str(x) for x in windows[tuple(w[k:k + n])] if x is not None}
        yield i, len(w), len(hit), len(items), ",".join(sorted(items))


def fixture():
    rng = random.Random(4)
    vocabulary = ["wört%d" % k if k % 5 else "x%d" % k for k in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary[:rng.choice([8, 300])]) for _ in range(n))
    bench = [(k, text(rng.choice([0, 1, 3, 12, 13, 14, 40]))) for k in range(40)] + [(None, text(20)), (3, None), (41, ""), (42, " - "), (43, "Solo")]
    bench += [(44, bench[5][1]), (5, bench[5][1])]
    docs = []
    for k in range(150):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            source = words(rng.choice(bench)[1])
            a = rng.randint(0, max(len(source) - 13, 0))
            parts += [", ".join(source[a:a + rng.randint(10, 30)]).upper(), text(rng.randint(0, 10))]
        docs.append((k // 2 if k < 20 else k, rng.choice(["", "  ", "."]) + " ".join(parts)))
    return docs + [(None, bench[30][1]), (500, None), (501, "")], bench


def answer(docs, bench):
    return sorted(map(str, map(tuple, decontam.contamination(docs, bench).drop("text_key").collect())))


def test_against_brute_force_both_ways(spark, monkeypatch):
    docs, bench = fixture()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    want = sorted(map(str, brute(docs, bench)))
    assert answer(d, b) == want
    monkeypatch.setattr(decontam, "broadcast_if_small", lambda df, size: (df, False))
    assert answer(d, b) == want
    assert common.broadcast_if_small(d, common.F.lit(1), 10)[1] is False


def test_odd_and_empty_tables(spark, odd, odd_texts, none):
    bench = [(1, odd_texts[7][1]), (2, "été à la")]
    table = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, doc_id string")
    assert answer(odd, table) == sorted(map(str, brute(odd_texts, bench)))
    assert answer(none, table) == []
    assert {r.n_hit for r in decontam.contamination(odd, table.limit(0)).collect()} == {0}
    kept = decontam.decontaminated(odd, table)
    bad = [(i, t) for (i, t), r in zip(odd_texts, brute(odd_texts, bench)) if r[2] and 20 * r[2] >= r[1]]
    assert kept.columns == odd.columns and kept.count() == len(odd_texts) - len(bad)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "d x x x x x x a x b x x c"), (3, "c a b d"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c d"), (8, "q"), (9, None)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.pos) for r in decontam.proximity_matches(docs, bench, terms=4, span=5).collect())
    assert got == [(1, 7, 3), (1, 7, 4), (3, 7, 3)] or got == [(1, 7, 3), (3, 7, 3)]
