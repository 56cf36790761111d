"""Scans over range partitions against plain Python; a key with most of the rows spans many pieces."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tariffloom.operators.pieces import placed, running, running_last, running_sum, running_xor
from tariffloom.sources.sinks import stored

ORDER = lambda: [F.col("k").asc_nulls_first(), F.col("n")]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    keys = ["hot"] * 600 + [None] * 150 + [f"k{i % 90}" for i in range(300)]
    rng.shuffle(keys)
    return [(k, i, rng.choice([None, 1, 2, 70])) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def table(spark, rows):
    spread = spark.createDataFrame(rows, "k string, n long, v long").repartition(9)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield stored(placed(spread, ORDER()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def by_key(rows):
    out = defaultdict(list)
    for k, n, v in sorted(rows, key=lambda r: r[1]):
        out[k].append((n, v))
    return out


def test_running_values_are_carried_over_the_cuts(table, rows):
    pieces = table.groupBy("k").agg(F.count_distinct(F.shiftright("_at", 33)).alias("n")).filter("n > 2")
    assert {r.k for r in pieces.collect()} >= {"hot"}
    v = F.coalesce("v", F.lit(0))
    got = running(table, ["k"], {"total": running_sum(v), "mixed": running_xor(v), "place": running_sum(F.lit(1))})
    found = {(r.k, r.n): (r.total, r.mixed, r.place) for r in got.collect()}
    for key, values in by_key(rows).items():
        total = mixed = 0
        for place, (n, value) in enumerate(values, 1):
            total, mixed = total + (value or 0), mixed ^ (value or 0)
            assert found.pop((key, n)) == (total, mixed, place)
    assert not found


def test_the_row_before(table, rows):
    got = running(table, ["k"], {"before": running_last(F.struct("n", "v"))}, past=True)
    found = {(r.k, r.n): r.before and tuple(r.before) for r in got.collect()}
    for key, values in by_key(rows).items():
        for earlier, (n, _) in zip([None, *values], values):
            assert found.pop((key, n)) == earlier
    assert not found


def test_no_row(spark, table):
    none = stored(placed(table.drop("_at").limit(0), ORDER()))
    assert running(none, ["k"], {"t": running_sum(F.col("v"))}).collect() == []
