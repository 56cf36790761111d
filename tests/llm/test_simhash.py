from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tariffloom.llm import simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits=4):
    """Component number of each fingerprint, by comparing all pairs."""
    known = sorted(set(prints))
    root = list(range(len(known)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(known, np.uint64)
    for i in range(len(known)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= bits):
            root[find(i + 1 + int(j))] = find(i)
    return {f: find(k) for k, f in enumerate(known)}


def test_documents(spark, odd, odd_texts, none):
    rows = [(i, fingerprint(t)) for i, t in odd_texts]
    group = groups([f for _, f in rows])
    least = {}
    for i, f in rows:
        if i is not None:
            least[group[f]] = min(least.get(group[f], i), i)
    got = simhash.near_duplicates(odd).collect()
    assert sorted(str((r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id)) for r in got) == sorted(str((i, f, least.get(group[f]))) for i, f in rows)
    assert simhash.near_duplicates(none).count() == 0


def test_one_row_of_each_component_stays(spark, odd, odd_texts, none):
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    group = groups([fingerprint(t) for _, t in odd_texts])
    assert sorted(group[fingerprint(r.text)] for r in rows) == sorted(set(group.values()))
    assert simhash.deduplicated(none).count() == 0


def test_links_of_dense_clusters_over_blocks(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(120):
            x = center
            for _ in range(rng.randint(0, 9)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(300)}
    table = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fingerprint long")
    want = groups(prints)
    for block in (2048, 16):
        from tariffloom.llm.common import components

        links = simhash.links(table, block)
        named = {r.node & (1 << 64) - 1: r.component for r in components(links).collect()}
        classes = {}
        for p in prints:
            classes.setdefault(want[p], set()).add(named.get(p, p if p < 1 << 63 else p - (1 << 64)))
        assert all(len(c) == 1 for c in classes.values())
        assert len(set().union(*classes.values())) == len(classes)


def test_long_chains(spark):
    from tariffloom.llm.common import components

    edges = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r.component for r in components(edges).collect()} == {0} and components(edges).count() == 301
    assert components(edges.limit(0)).count() == 0
