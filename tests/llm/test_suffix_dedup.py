from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffloom.llm import induced_sort, suffix_dedup
from tariffloom.llm.disk_queue import DiskQueue
from tariffloom.llm.windows import WINDOW, stretches

LAST = suffix_dedup.LAST


def brute(rows):
    """Removal by looking up every 50-byte string."""
    least = {}
    texts = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for k in range(len(t) - WINDOW + 1):
            w = t[k:k + WINDOW]
            least[w] = min(least.get(w, i), i)
    for (name, _), (i, t) in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - WINDOW + 1):
            if least[t[k:k + WINDOW]] < i:
                gone[k:k + WINDOW] = b"\1" * WINDOW
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        yield name, len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()


def answer(docs):
    return sorted(map(str, map(tuple, suffix_dedup.deduplicated(docs).drop("kept").collect())))


def test_documents(odd, odd_texts, none):
    assert answer(odd) == sorted(map(str, brute(odd_texts)))
    assert suffix_dedup.deduplicated(none).count() == 0


def test_shared_passages_in_small_parts(spark, monkeypatch):
    rng = random.Random(2)
    piece = lambda n, letters="abcdefg ": "".join(rng.choice(letters) for _ in range(n))
    common = [piece(rng.randint(30, 200)) for _ in range(6)] + ["xy" * 70, "z" * 120, piece(80, "\x00a")]
    rows = [(rng.randint(0, 60), "".join(rng.choice(common)[rng.randint(0, 9):] if rng.random() < 0.6 else piece(rng.randint(0, 70))
                                         for _ in range(rng.randint(0, 7)))) for _ in range(120)]
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert answer(docs) == sorted(map(str, brute(rows)))


def test_copies_beside_other_texts_of_their_id(spark):
    """A copy stays one row, wholly removed, whatever else has its id."""
    rng = random.Random(5)
    p, x, y, z, w = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (90, 70, 70, 70, 70))
    rows = [(1, p + x), (2, p + y), (7, p + x), (7, z + p), (None, p + x), (None, w + p), (None, p + x), (9, p + y), (9, p + y), (9, z + p + w)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 6):
        assert answer(docs.repartition(parts)) == sorted(map(str, brute(rows)))


def test_lists_of_rows_without_an_id_are_one_document_s(spark):
    """Rows that share an id, or have none, get the anchors of their own text only."""
    rng = random.Random(6)
    p = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(p)] + [(None, "x" + t) for t in p] + [(77, "y" + t) for t in p] + [(-(1 << 63), p[3] + "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts = suffix_dedup.keyed(docs, "doc_id", "text").select("id", "key", "spot", "text")
    lists = suffix_dedup.repeated_anchors(texts, 4).groupBy("spot").agg(F.collect_list("keys").alias("keys")).collect()
    assert len(lists) == len(rows)
    for r in lists:
        assert len(set(np.frombuffer(b"".join(r["keys"]), np.uint64))) <= 240 - WINDOW
    assert answer(docs) == sorted(map(str, brute(rows)))


def test_documents_that_share_a_spot(spark, monkeypatch):
    rng = random.Random(8)
    piece = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common = [piece(rng.randint(60, 150)) for _ in range(4)]
    rows = [(rng.choice([None, *range(12)]), "".join(rng.choice(common) if rng.random() < 0.6 else piece(40) for _ in range(rng.randint(0, 4))))
            for _ in range(60)]
    monkeypatch.setattr(suffix_dedup, "spot_of", lambda *cols: F.xxhash64(*cols).bitwiseAND(F.lit(3)))
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(docs) == sorted(map(str, brute(rows)))


def test_queue_orders_records_with_and_without_disk():
    rng = np.random.default_rng(1)
    kind = np.dtype([("key", "u8"), ("came", "i8")])
    rows = np.zeros(1000, kind)
    rows["key"], rows["came"] = rng.integers(0, 90, 1000), np.arange(1000)
    want = rows[np.argsort(rows["key"], kind="stable")]
    for limit in (5000, 64, 17):
        queue = DiskQueue(kind, limit)
        for a in range(0, 1000, 30):
            queue.push(rows[a:a + 30])
        assert (np.concatenate(list(queue.drain())) == want).all()
        assert not list(queue.drain())


def test_sort_beyond_memory_marks_the_same_windows():
    rng = random.Random(3)
    piece = lambda n, letters: bytes(rng.choice(letters) for _ in range(n))
    for letters in (b"ab", b"abcdefgh ", b"a\0", bytes(range(256))):
        parts = [piece(rng.randint(20, 300), letters) for _ in range(5)]
        texts = [b"".join(rng.choice(parts)[rng.randint(0, 30):] for _ in range(rng.randint(0, 5))) for _ in range(15)]
        ids = [rng.randint(0, 20) for _ in texts]
        found = stretches(texts)
        rows = np.zeros(len(found.doc), induced_sort.SAMPLED)
        for k in range(len(rows)):
            text, first, last, anchor = texts[found.doc[k]], int(found.first[k]), int(found.last[k]), int(found.anchor[k])
            left = text[first:anchor][::-1]
            rows[k]["key"] = text[anchor:last + WINDOW]
            rows[k]["left"][:len(left)] = np.frombuffer(left, np.uint8)
            rows[k]["size"], rows[k]["near"], rows[k]["owner"], rows[k]["record"] = anchor - first, anchor - last, ids[found.doc[k]], k
        results = []
        for limit, block in ((1 << 17, 10_000), (200, 60)):
            marks = induced_sort.repeated_windows((rows[a:a + block] for a in range(0, len(rows), block)), limit)
            results.append({(int(r), int(m)) for rs, ms in marks for r, m in zip(rs, ms)})
        assert results[0] == results[1]
        least = {}
        for t, i in zip(texts, ids):
            for k in range(len(t) - WINDOW + 1):
                least[t[k:k + WINDOW]] = min(least.get(t[k:k + WINDOW], i), i)
        want = {(int(found.doc[r]), s) for r in range(len(rows)) for s in range(int(found.first[r]), int(found.last[r]) + 1)
                if least[texts[found.doc[r]][s:s + WINDOW]] < ids[found.doc[r]]}
        assert {(int(found.doc[r]), int(found.anchor[r]) - j) for r, m in results[0] for j in range(64) if m >> j & 1} == want


@pytest.mark.parametrize("copies", [1, 3000])
def test_rows_that_repeat_one_document_are_one(spark, monkeypatch, copies):
    """The lists of a document are as long with 3,000 equal rows as with one."""
    rng = random.Random(2)
    p = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    rows = [(7, p)] * copies + [(None, p + "x")] * copies + [(1, p + " tail"), (2, "head " + p)]
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 200_000)  # so that many tasks and blocks meet the copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    lists, real = [], suffix_dedup.removed_intervals

    def seen(windows):
        found = windows.groupBy("id", "key").agg(F.size(F.collect_set(F.struct("places", "mask"))).alias("n")).agg(F.max("n")).first()[0]
        lists.append(found)
        return real(windows)

    monkeypatch.setattr(suffix_dedup, "removed_intervals", seen)
    assert answer(docs) == sorted(map(str, brute(rows)))
    assert lists[0] <= 1500 // 10


def test_a_bucket_beyond_memory_finds_the_same_anchors(spark):
    rng = random.Random(9)
    p = ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(10)]
    rows = [(k, rng.choice(p) + rng.choice(p)) for k in range(40)]
    texts = suffix_dedup.keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "doc_id", "text").select("id", "key", "spot", "text")
    found = []
    for in_memory in (suffix_dedup.IN_MEMORY, 16):
        out = {}
        for r in suffix_dedup.repeated_anchors(texts, 4, in_memory).collect():
            out.setdefault(r.spot, set()).update(np.frombuffer(r["keys"], np.uint64).tolist())
        found.append(out)
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_keys_sent_twice_in_blocks():
    rng = np.random.default_rng(4)
    rows = np.zeros(500, suffix_dedup.ANCHOR)
    rows["key"], rows["owner"] = np.sort(rng.integers(0, 250, 500)), rng.integers(0, 6, 500)
    many = {int(k) for k in rows["key"] if (rows["key"] == k).sum() > 1}
    want = {(int(k), int(o)) for k, o in zip(rows["key"], rows["owner"]) if int(k) in many}
    for size in (500, 1, 2, 3, 64):
        got = [(int(k), int(o)) for ks, os in suffix_dedup.sent_twice(rows[a:a + size] for a in range(0, 500, size)) for k, o in zip(ks, os)]
        assert set(got) == want
