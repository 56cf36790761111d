from __future__ import annotations

import itertools
import os
import re
import subprocess
import sys
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tariffloom.llm.packing import EXACT, FINE, bin_of, boundaries, counted, histogram, pack, word_count


def test_boundaries_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = rng.integers(1, 9)
        tops, counts, k = np.sort(rng.choice(40, n, replace=False)), rng.integers(1, 9, n), int(rng.integers(1, 5))
        cost = lambda bs: sum(int(counts[i]) * (min(b for b in bs if b >= tops[i]) - int(tops[i])) for i in range(n))
        best = min(cost([*c, tops[-1]]) for m in range(k) for c in itertools.combinations(tops[:-1], m))
        got = boundaries(counts, counts * tops, tops, k)
        assert cost(got) == best and len(got) <= k
    assert boundaries([], [], [], 4) == []


def test_boundaries_of_long_texts_are_optimal(spark):
    sizes = {1025: 30, 1030: 9, 1039: 7, 5000: 20, 5003: 6, 5060: 3, 70_001: 8, 70_900: 5}
    rows = spark.createDataFrame([(k, n) for n, times in sizes.items() for k in range(times)], "doc_id long, length long")
    cost = lambda bs: sum(times * (min(b for b in bs if b >= n) - n) for n, times in sizes.items())
    best = min(cost([*c, max(sizes)]) for c in itertools.combinations(sorted(sizes)[:-1], 4))
    got = pack(rows.select("doc_id", (F.col("length") + 0).alias("length")), buckets=5).collect()
    assert sum(r.padding for r in got) == best
    assert [(r.top, r.n, r.tokens) for r in counted(rows)] == sorted((n, times, n * times) for n, times in sizes.items())
    assert counted(rows, distinct=7) == sorted(histogram(rows).collect(), key=lambda r: r.top)


def test_bins_are_bounded_and_ordered(spark):
    lengths = [*range(5000), 10**6, 10**9, 2**31 - 1, 2**31]
    rows = spark.createDataFrame([(x,) for x in lengths], "length long").select("length", bin_of(F.col("length")).alias("bin")).orderBy("length").collect()
    bins = [r.bin for r in rows]
    assert bins == sorted(bins) and bins[:EXACT] == list(range(EXACT)) and bins[-1] < EXACT + 22 * FINE


def test_word_count(spark, odd, odd_texts):
    got = sorted(r.n for r in odd.select(word_count(F.col("text")).alias("n")).collect())
    assert got == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in odd_texts)


def test_batches(spark, odd, odd_texts, none):
    length = word_count(F.col("text")).alias("length")
    rows = pack(odd.select("doc_id", length), budget=400, buckets=5).collect()
    assert len(rows) == len(odd_texts)
    batches, per_bucket = defaultdict(list), defaultdict(set)
    for r in rows:
        assert 0 <= r.padding == r.bucket_len - r.length
        batches[r.bucket, r.batch].append(r.slot)
        per_bucket[r.bucket].add((r.batch, r.bucket_len))
    for (bucket, batch), slots in batches.items():
        size = next(n for b, n in per_bucket[bucket] if b == batch)
        room = max(400 // max(size, 1), 1)
        last = batch == max(b for b, _ in per_bucket[bucket])
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room and (last or len(slots) == room)
    assert pack(none.select("doc_id", length)).count() == 0


def test_many_slices(spark):
    from tariffloom.llm.packing import assigned

    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(7).cast("long").alias("length"), F.col("id").alias("_row"))
    got = assigned(rows, "length", [7], budget=70, slice_rows=64, order=["doc_id"]).groupBy("batch").count().collect()
    assert len(got) == 100 and {r["count"] for r in got} == {10}


def test_a_session_that_packs_first(tmp_path):
    """A process of its own, whose first query is ``pack``; an extra column named like a result is replaced, others stay."""
    code = (
        "from pyspark.sql import SparkSession\n"
        f"spark = SparkSession.builder.master('local[2]').config('spark.checkpoint.dir', {str(tmp_path)!r}).config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from tariffloom.llm.packing import pack\n"
        "rows = spark.createDataFrame([(i, i * 7 % 40, 'mine', 'kept') for i in range(10)], 'doc_id long, length long, bucket string, other string')\n"
        "out = pack(rows).collect()\n"
        "assert len(out) == 10 and {r.other for r in out} == {'kept'} and all(r.padding == r.bucket_len - r.length for r in out)\n")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=200)
    assert run.returncode == 0, run.stderr[-1500:]
