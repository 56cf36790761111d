"""The trie against nested Python lists; shards, strips and queues cut small."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tariffloom.llm import prefix_trie
from tariffloom.llm.disk_queue import DiskQueue


def brute(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in said.items()}
    built = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in children[node])
    out = Counter()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out[min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    """Short, empty and one very long conversation, ties, NULLs, negative ids, absent bases, repeated rows."""
    rng = random.Random(3)
    out = [(None, 1, "u", "x"), (7, None, None, None)] + [(7, 1, "u", "same")] * 40 + [(300, k, "u", f"t{k % 3}") for k in range(1500)]
    for c in [*range(-5, 40), *range(100, 160), 205, 299, -250]:
        for k in range(max(rng.choice([0, 1, 2, 3, 4, 5, 8, 30]), 1)):
            out.append((c, rng.choice([k, k, None, 0]), rng.choice(["u", None, "a"]), rng.choice(["x", "yy", None, "hello é😀"])))
    return out


@pytest.fixture(scope="module")
def turns(spark, rows):
    odd = [(*r, 1, 2, "x", 3) for r in rows]
    schema = "conv_id long, turn long, role string, text string, depth long, d long, conv string, size int"
    return spark.createDataFrame(odd, schema).repartition(5)


@pytest.mark.parametrize("sizes", [{}, {"light": 3}, {"light": 2, "band": 3, "limit": 4}, {"light": 5000, "band": 7}])
def test_nodes(turns, rows, sizes):
    assert Counter(map(tuple, prefix_trie.trie(turns, **sizes).collect())) == brute(rows)


def test_equal_conversations(spark):
    """A third of the conversations are one text, another third share their first turn."""
    rows = [(100 * c, k, "u", f"t{k}") for c in range(300) for k in range(4)]
    rows += [(100 * c, k, "u", "t0" if k == 0 else f"o{c}-{k}") for c in range(300, 600) for k in range(3)]
    rows += [(100 * c, k, "u", f"p{c}-{k}") for c in range(600, 900) for k in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert Counter(map(tuple, prefix_trie.trie(df, light=8).collect())) == brute(rows)


def test_no_rows(spark, turns):
    assert prefix_trie.trie(turns.limit(0)).collect() == []
    assert prefix_trie.trie(turns.filter("conv_id IS NULL")).collect() == []


def test_messages_arrive_in_order():
    rng = np.random.default_rng(1)
    queue, sent = DiskQueue(prefix_trie.MESSAGE, 8), []
    for _ in range(20):
        part = np.zeros(rng.integers(0, 9), prefix_trie.MESSAGE)
        part["key"], part["leaves"] = rng.integers(0, 30, len(part)), 1
        queue.push(part)
        sent += part["key"].tolist()
    arrivals, got = prefix_trie.Arrivals(queue), []
    for last in (3, 3, 17, 40):
        block = [k for b in arrivals.until(last) for k in b["key"].tolist()]
        assert all(k <= last for k in block)
        got += block
    assert got == sorted(sent)
