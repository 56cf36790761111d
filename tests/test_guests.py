"""Guests, weekdays and discount days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tariffloom.functions import predicates as pr
from tariffloom.functions import weekdays as wd
from tariffloom.operators.availability import with_party
from tariffloom.params import Stay


def classify(spark, ages, lo=2, hi=12):
    df = spark.createDataFrame([(ages, lo, hi)], "ages array<int>, minimum_child_age int, maximum_child_age int")
    return with_party(df, F.col("ages")).first()


@pytest.mark.parametrize(
    "ages, expected",
    [([1, 5, 30, 30], (2, 1, 1)), ([30, 30], (2, 0, 0)), ([1, 1, 5, 7, 30], (1, 2, 2)), ([1], (0, 0, 1)),
     ([13, 14, 12], (2, 1, 0))],
)
def test_bands(spark, ages, expected):
    row = classify(spark, ages)
    assert (row.adults, row.childes, row.infants) == expected
    assert row.adults + row.childes + row.infants == len(ages)
    assert row.paxes == len(ages) - row.infants


def test_ordinals(spark):
    guests = classify(spark, [7, 30, 5, 1, 7, 0]).guests
    assert [g.age for g in guests] == [30, 7, 7, 5, 1, 0]
    assert [g.pax_id for g in guests] == [1, 2, 3, 4, 5, 6]
    assert [g.child_id for g in guests] == [None, 2, 3, 1, None, None]
    assert [g.infant_id for g in guests] == [None, None, None, None, 2, 1]


def test_stay_weekdays():
    stay = Stay(dt.date(2018, 4, 20), dt.date(2018, 4, 30), (1, 5, 30, 30), dt.date(2018, 4, 1))
    # Sunday .. Saturday
    assert stay.weekdays == (2, 1, 1, 1, 1, 2, 2)
    assert stay.nights == 10


def test_stay_needs_nights_and_guests():
    with pytest.raises(ValueError):
        Stay(dt.date(2018, 4, 20), dt.date(2018, 4, 20), (30,), dt.date(2018, 4, 1))
    with pytest.raises(ValueError):
        Stay(dt.date(2018, 4, 20), dt.date(2018, 4, 21), (), dt.date(2018, 4, 1))


def test_discount_days(spark):
    flags = ", ".join(f"{f} string" for f in wd.DAY_FLAGS)
    friday_saturday = ["N", "N", "N", "N", "N", "Y", "Y"]
    df = spark.createDataFrame(
        [(friday_saturday + ["B"]), (friday_saturday + ["T"]), ([None] * 7 + ["B"])], f"{flags}, application_type string"
    )
    counts = F.array(*[F.lit(n) for n in (2, 1, 1, 1, 1, 2, 2)])
    got = df.select(wd.discount_days(wd.weekday_mask(), counts, F.col("application_type"))).collect()
    assert [r[0] for r in got] == [4, 1, 0]


def test_any_age_differs_from_one_guest(spark):
    df = spark.createDataFrame([(10, 20), (0, 12), (None, None), (40, 50)], "lo int, hi int")
    ages = F.array(F.lit(5), F.lit(30))
    lo, hi = F.col("lo"), F.col("hi")
    assert [r[0] for r in df.select(pr.any_age(ages, lo, hi)).collect()] == [True, True, True, False]
    one = F.exists(ages, lambda a: pr.in_band(a, lo, hi))
    assert [r[0] for r in df.select(one).collect()] == [False, True, True, False]


def test_wildcards_and_rates(spark):
    df = spark.createDataFrame([("",), (None,), ("A",), ("B",)], "rule string")
    assert [r[0] for r in df.select(pr.wildcard_match(F.col("rule"), F.lit("A"))).collect()] == [True, True, True, False]
    rates = spark.createDataFrame(
        [("3", None), (None, "4"), (None, "0"), (None, None), ("3", "4")], "g string, s string"
    )
    assert [r[0] for r in rates.select(pr.rule_rate(F.col("g"), F.col("s"))).collect()] == ["3", "4", None, None, "3"]
