"""Ranges, by hand-made cases."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv


def day(n):
    return None if n is None else dt.date(2020, 1, 1) + dt.timedelta(days=n)


def dates(spark, rows):
    return spark.createDataFrame([tuple(day(x) for x in r) for r in rows], "a date, b date, c date, d date")


CASES = [
    ((0, 5, 5, 9), False),   # touching ends
    ((0, 9, 2, 4), True),    # contained
    ((5, 0, 4, 9), True),    # reversed ends
    ((3, 3, 3, 9), True),    # instant on the start
    ((5, 5, 3, 9), True),    # instant inside
    ((9, 9, 3, 9), False),   # instant on the end
    ((4, 4, 4, 4), True),    # two equal instants
    ((4, 4, 5, 5), False),
    ((0, None, 1, 5), None),  # unknown end
]


def test_overlaps(spark):
    df = dates(spark, [c for c, _ in CASES])
    got = [r[0] for r in df.select(iv.overlaps(*[F.col(c) for c in "abcd"])).collect()]
    assert got == [e for _, e in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 12)] * 4), min_size=30, max_size=60))
def test_overlaps_is_symmetric(spark, rows):
    df = dates(spark, rows)
    a, b, c, d = [F.col(x) for x in "abcd"]
    assert df.filter(iv.overlaps(a, b, c, d) != iv.overlaps(c, d, a, b)).count() == 0
    assert df.filter(iv.overlaps(a, b, c, d) != iv.overlaps(b, a, d, c)).count() == 0


@pytest.mark.parametrize(
    "lo, hi, nights", [(0, 3, 0), (5, 12, 2), (11, 14, 3), (14, 20, 2), (16, 20, 0), (0, 30, 6)]
)
def test_common_nights(spark, lo, hi, nights):
    df = dates(spark, [(lo, hi, 10, 16)])
    assert df.select(iv.common_nights(*[F.col(c) for c in "abcd"])).first()[0] == nights


def test_common_nights_unknown_end(spark):
    assert dates(spark, [(0, None, 1, 5)]).select(iv.common_nights(*[F.col(c) for c in "abcd"])).first()[0] is None


def test_age_ranges(spark):
    df = spark.createDataFrame([(a,) for a in (1, 2, 12, 13)], "age int")
    closed = iv.closed_int_range(F.lit(2), F.lit(12))
    assert [r[0] for r in df.select(iv.in_range(F.col("age"), closed)).collect()] == [False, True, True, False]
    none = iv.closed_int_range(F.lit(None).cast("int"), F.lit(None).cast("int"))
    assert all(r[0] for r in df.select(iv.age_allowed(F.col("age"), none)).collect())
    empty = iv.empty_int_range()
    assert not any(r[0] for r in df.select(iv.in_range(F.col("age"), empty)).collect())
    assert all(r[0] for r in df.select(iv.age_allowed(F.col("age"), empty)).collect())


def test_windows_and_containment(spark):
    df = dates(spark, [(0, 9, 0, 9), (1, 9, 1, 8), (None, None, 0, 1), (5, None, 0, 1)])
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(iv.covers(a, b, F.lit(day(0)), F.lit(day(9)))).collect()][:2] == [True, False]
    assert [r[0] for r in df.select(iv.covers_strictly(a, b, F.lit(day(1)), F.lit(day(8)))).collect()][:2] == [True, False]
    assert [r[0] for r in df.select(iv.open_window(a, b, F.lit(day(3)))).collect()] == [True, True, True, False]
