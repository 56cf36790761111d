"""Overlap joins by bins against brute force, the cache of crowded contracts, and exact coverage of cached offers."""

from __future__ import annotations

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tariffloom.operators import cache as cache_ops
from tariffloom.operators.interval_join import overlap_join
from tariffloom.params import Stay
from tariffloom.schemas import CACHE
from tariffloom.sources.derived import DerivedContracts

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DAY = dt.date(2018, 1, 1)


def date(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def test_overlaps_are_met_once(spark):
    """Short, long, very long, empty, reversed and half-known ranges, before 1970 too."""
    rng = random.Random(4)

    def ranges(n, tag):
        out = []
        for i in range(n):
            lo = rng.choice([rng.randint(-400, 400), rng.randint(-30_000, 30_000)])
            size = rng.choice([0, 1, 1, 5, 60, 64, 200, 1024, 1025, 20_000, -3])
            out.append((f"{tag}{i}", rng.choice("xy"), date(lo), None if i % 37 == 0 else date(lo + size)))
        return out

    left, right = ranges(250, "l"), ranges(250, "r")
    a = spark.createDataFrame(left, "l string, k string, a date, b date")
    b = spark.createDataFrame(right, "r string, k string, c date, d date")
    got = [(x.l, x.r) for x in overlap_join(a, b, ["k"], ("a", "b", "c", "d")).collect()]
    real = lambda lo, hi: hi is not None and lo < hi
    want = {(x[0], y[0]) for x in left for y in right
            if x[1] == y[1] and real(*x[2:]) and real(*y[2:]) and max(x[2], y[2]) < min(x[3], y[3])}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")
def test_bins_build_the_same_cache(spark):
    tables = DerivedContracts(spark, SF)
    assert cache_ops.crowded_buckets(tables.table("cnsr"), 0) and not cache_ops.crowded_buckets(tables.table("cnsr"))
    plain, binned = cache_ops.build_cache(tables), cache_ops.build_cache(tables, crowded_over=0)
    assert plain.exceptAll(binned).count() == 0 and binned.exceptAll(plain).count() == 0


class OneRoom:
    """A contract of one room with many prices and many rules of one rate, over seven years."""

    def __init__(self, spark, prices, rules):
        rng = random.Random(9)
        days = lambda n: [rng.randint(0, 2500) for _ in range(n)]
        p = [("f", "r", "a", i, date(d), date(d + rng.randint(30, 80)), "1", None, "BB", 10.0, "N") for i, d in enumerate(days(prices))]
        r = [("f", rng.choice(["r", "", None]), "a", i, "HB", 1.0, None, "N", 1, date(d), date(d + 180), None, None) for i, d in enumerate(days(rules))]
        self.cnct = spark.createDataFrame(p, "file_id string, room_type string, characteristic string, id long, initial_date date, final_date date, "
                                          "generic_rate string, specific_rate string, base_board string, amount double, is_price_per_pax string")
        self.cnsr = spark.createDataFrame(r, "file_id string, room_type string, characteristic string, rule_id long, board_code string, amount double, "
                                          "percentage double, is_per_pax string, rate int, initial_date date, final_date date, min_age int, max_age int")
        self.rooms = spark.createDataFrame([("f", "r", "a", "ES")], "file_id string, room_type string, characteristic string, country_code string")


def test_a_crowded_room_does_not_build_the_product(spark):
    t = OneRoom(spark, 3000, 3000)
    crowded = cache_ops.crowded_buckets(t.cnsr)
    assert len(crowded) == 1
    joined = cache_ops.boarded_prices(t.cnct, cache_ops.board_choices(t.rooms, t.cnsr, crowded), crowded).cache()
    met, kept = joined.count(), joined.filter(cache_ops.takes_board()).count()
    plain = cache_ops.boarded_prices(t.cnct, cache_ops.board_choices(t.rooms, t.cnsr, []), [])
    assert kept == plain.filter(cache_ops.takes_board()).count() > 500_000
    assert met <= 2 * kept
    joined.unpersist()


def test_a_price_row_is_sent_once_and_meets_the_rules_of_its_rate(spark):
    """Own board and rules in one slot: rates that share a bucket, without a rate, blank, '0'; plain and in bins alike."""
    t, rng = OneRoom(spark, 0, 0), random.Random(2)
    span = lambda: (lambda d: (date(d), date(d + rng.choice([0, 20, 90]))))(rng.randint(0, 300))
    p = [("f", "r", "a", i, *span(), rng.choice([None, "", "0", *map(str, range(1, 13))]), rng.choice([None, "", "0", "3", "7"]), "BB", 10.0, "N") for i in range(150)]
    r = [("f", rng.choice(["r", "", None]), "a", i, "HB", 1.0, None, "N", rng.choice([None, *range(13)]), *span(), None, None) for i in range(150)]
    cnct, cnsr = spark.createDataFrame(p, t.cnct.schema), spark.createDataFrame(r, t.cnsr.schema)
    assert cache_ops.sent_prices(cnct, []).count() == len(p)
    rate = lambda x: (x[6] or None) if x[6] is not None else (x[7] if x[7] not in ("", "0") else None)
    want = sorted([(x[3], None) for x in p] + [
        (x[3], y[9]) for x in p for y in r if y[8] is not None and rate(x) == str(y[8]) and max(x[4], y[9]) < min(x[5], y[10])], key=str)
    for crowded in ([], cache_ops.crowded_buckets(cnsr, 0)):
        joined = cache_ops.boarded_prices(cnct, cache_ops.board_choices(t.rooms, cnsr, crowded), crowded)
        assert sorted(((x.id, x.rule_lo) for x in joined.filter(cache_ops.takes_board()).collect()), key=str) == want


STAY = Stay(dt.date(2018, 8, 20), dt.date(2018, 8, 26), (30, 30), dt.date(2018, 8, 1))


def test_cached_offers_have_a_price_for_every_night(spark):
    """A night with two prices doesn't stand in for one without: summed nights would sell room B."""
    night = lambda n: STAY.check_in + dt.timedelta(days=n)
    rows = [("A", 0, 4, 10.0), ("A", 4, 6, 20.0), ("B", 0, 4, 10.0), ("B", 2, 4, 10.0), ("C", -3, 3, 10.0), ("C", 2, 9, 30.0), ("D", 0, 5, 10.0)]
    base = {"file_id": "f", "board": "BB", "cnsr_amount": 0.0, "cnsr_percentage": 0.0, "cnsr_is_per_pax": "", "is_price_per_pax": "N",
            "min_nights": 0, "childe_ages": (2, 11), "standard_capacity": 2, "min_pax": 1, "max_pax": 4, "max_adult": 4, "max_children": 2,
            "max_infant": 1, "min_adult": 1, "min_children": 0, "cnsr_pax_ages": (0, 0), "rate": "1", "city_code": "X_1", "country_code": "X"}
    schema = spark.createDataFrame([], CACHE).schema
    made = [tuple({**base, "rt_id": r, "room_type": r, "lo": night(a), "hi": night(b), "amount": amount}.get(c) for c in schema.fieldNames())
            for r, a, b, amount in rows]
    found = cache_ops.priced_offers(spark.createDataFrame(made, schema), STAY)
    got = {r.rt_id: (r.sum_nights, round(r.room_price, 4)) for r in found.collect()}
    assert got == {"A": (6, round(80 / 6, 4)), "C": (7, round((3 * 10 + 4 * 30) / 7, 4))}
    assert Counter(r.rt_id for r in found.collect()) == Counter("AC")
