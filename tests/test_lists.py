"""Pair rules, term arrays, dictionary joins, reconciliation."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tariffloom.functions import pricing as px
from tariffloom.functions.keys import md5_key, surrogate
from tariffloom.operators import reconcile as rec
from tariffloom.operators import rooms, rule_list, terms
from tariffloom.operators.availability import available_rooms, covered_rooms, sold_rooms
from tariffloom.params import Stay
from tariffloom.plans.common import FAMILY

LISTED = "cnct_id string, file_id string, sad_name string, sad_code string"


@pytest.mark.parametrize(
    "included, codes, left",
    [("Y", ["D1", "D2"], {"D1"}), ("Y", ["D2"], {"D2"}), ("N", ["D1", "D2"], {"D1", "D2"}), ("N", ["D2"], set())],
)
def test_pair_rules(spark, included, codes, left):
    listed = spark.createDataFrame([("o", "F", "cnsu", c) for c in codes] + [("o", "F", "cnsr", None)], LISTED)
    cnoe = spark.createDataFrame([("F", "D1", "D2", included)], "file_id string, code1 string, code2 string, is_included string")
    rows = rule_list.drop_incompatible(listed, cnoe).collect()
    assert {r.sad_code for r in rows if r.sad_code} == left
    assert sum(r.sad_code is None for r in rows) == 1  # rows without a code are never deleted


def test_pair_rules_are_one_pass_and_per_offer(spark):
    listed = spark.createDataFrame(
        [("a", "F", "cnsu", "D1"), ("a", "F", "cnsu", "D2"), ("a", "F", "cnsu", "D3"), ("b", "F", "cnsu", "D3"),
         ("c", "G", "cnsu", "D2")], LISTED)
    cnoe = spark.createDataFrame(
        [("F", "D1", "D2", "Y"), ("F", "D2", "D3", "Y")], "file_id string, code1 string, code2 string, is_included string")
    got = {(r.cnct_id, r.sad_code) for r in rule_list.drop_incompatible(listed, cnoe).collect()}
    # D3 goes although D2, its partner, goes as well; other offers and contracts are untouched
    assert got == {("a", "D1"), ("b", "D3"), ("c", "D2")}


def test_board_flag_reaches_discounts(spark):
    listed = spark.createDataFrame(
        [("o", "cnsr", "N"), ("o", "cnsr", "Y"), ("o", "cnsu", None), ("p", "cnsu", None)],
        "cnct_id string, sad_name string, cnsr_is_per_pax string")
    got = {(r.cnct_id, r.sad_name): r.cnsr_is_per_pax for r in rule_list.carry_board_flag(listed).collect()
           if r.sad_name == "cnsu"}
    assert got == {("o", "cnsu"): "Y", ("p", "cnsu"): None}


def test_terms_keep_duplicates_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 2.0, None), ("a", None, 5.0), ("a", 2.0, None), ("b", 1.0, None)], "k string, amount double, pct double")
    got = {r.k: json.loads(r.j) for r in
           terms.listed_terms(df, ["k"], ["amount", "pct"]).select("k", terms.as_json(F.col("terms")).alias("j")).collect()}
    assert got["a"] == [{"amount": None, "pct": 5.0}, {"amount": 2.0, "pct": None}, {"amount": 2.0, "pct": None}]
    assert got["b"] == [{"amount": 1.0, "pct": None}]


@pytest.mark.parametrize(
    "room_flag, flag, amount, pct, expected",
    [("N", "N", 10.0, None, 10.0), ("N", "Y", 10.0, None, 30.0), ("N", "N", None, 10.0, 20.0),
     ("N", "Y", 0.0, 10.0, 30.0), ("Y", "N", None, 10.0, 120.0), ("Y", "Y", None, 10.0, 120.0), ("Y", "Y", 0.0, 0.0, 0.0)],
)
def test_board_terms(spark, room_flag, flag, amount, pct, expected):
    """Room 200, capacity 2, three guests; a percentage is of the room total."""
    df = spark.createDataFrame([(200.0, room_flag, flag, [(amount, pct)])],
                               "a double, rf string, f string, terms array<struct<amount: double, pct: double>>")
    guests = F.lit(3)
    room = px.room_total(F.col("a"), F.col("rf"), guests)
    got = df.select(px.board_total(F.col("terms"), room, F.col("rf"), F.lit(2), guests, F.col("f"))).first()[0]
    assert got == pytest.approx(expected)


def test_prefix_join(spark):
    texts = spark.createDataFrame([("LARGE ROOM",), ("LARGO",), ("X",), (None,)], "descr string")
    names = spark.createDataFrame([("large",), ("lar",), ("Large room deluxe",), ("x",)], "name string")
    got = {(r.descr, r.name) for r in rooms.prefix_join(texts, "descr", names, "name").collect()}
    assert got == {("LARGE ROOM", "large"), ("LARGE ROOM", "lar"), ("LARGO", "lar"), ("X", "x"), (None, None)}


def test_or_join_equals_nested_loop(spark):
    rnd = random.Random(2)
    price = [(i, rnd.choice("FG"), rnd.choice("RS"), rnd.choice("AN")) for i in range(30)]
    rule = [(rnd.choice("FG"), rnd.choice(["R", "S", None]), rnd.choice(["A", "N", None]), rnd.choice("NB"),
             float(rnd.randint(1, 5))) for _ in range(60)]
    p = spark.createDataFrame(price, "id int, file_id string, room_type string, characteristic string")
    r = spark.createDataFrame(rule, "file_id string, room_type string, characteristic string, type string, amount double")
    got = {x.id: (x.rules, x.rule_amount) for x in rooms.or_join(p, r).collect()}
    for pid, f, room, char in price:
        hits = [a for rf, rr, rc, t, a in rule
                if (rf == f and rr == room and rc == char) or (rr == room and rc is None)
                or (rr is None and rc is None and t == "N")]
        assert got[pid] == (len(hits), pytest.approx(sum(hits)))


def test_availability_counts_nights(spark):
    def prices(rows):
        return spark.createDataFrame(
            [("F", room, "A", "BB", "N", lo, hi, 10.0) for room, lo, hi in rows],
            "file_id string, room_type string, characteristic string, base_board string, is_price_per_pax string, lo string, "
            "hi string, amount double",
        ).select("*", F.col("lo").cast("date").alias("initial_date"), F.col("hi").cast("date").alias("final_date"))

    df = prices([
        ("two", "1998-08-01", "1998-08-23"), ("two", "1998-08-23", "1998-09-01"),    # adjacent intervals
        ("gap", "1998-08-01", "1998-08-22"), ("gap", "1998-08-23", "1998-09-01"),    # one night missing
        ("twice", "1998-08-01", "1998-08-24"), ("twice", "1998-08-20", "1998-08-24"),  # overlapping, not covering
        ("none", "1998-08-21", "1998-08-21"), ("back", "1998-08-30", "1998-08-10"),  # no night, reversed
        ("more", "1998-08-01", "1998-08-23"), ("more", "1998-08-22", "1998-08-31"),  # overlapping, covering
    ])
    summed = {r.room_type: r.sum_nights for r in available_rooms(df, FAMILY).collect()}
    exact = {r.room_type: r.covered_nights for r in covered_rooms(df, FAMILY).collect()}
    sold = {r.room_type: (r.sum_nights, float(r.stay_amount)) for r in sold_rooms(df, FAMILY).collect()}
    assert summed == {"two": 6, "twice": 8, "more": 7}
    assert exact == {"two": 6, "more": 6}
    assert sold == {"two": (6, 60.0), "more": (7, 70.0)}
    long = Stay(dt.date(1998, 1, 1), dt.date(1998, 7, 20), (30,), dt.date(1998, 1, 1))  # more nights than one number has bits
    whole = prices([("whole", "1997-12-01", "1998-05-05"), ("whole", "1998-05-05", "1998-08-01"), ("hole", "1997-12-01", "1998-05-05"),
                    ("hole", "1998-05-06", "1998-08-01")])
    assert [r.room_type for r in sold_rooms(whole, long).collect()] == ["whole"]


def test_reconciliation(spark):
    key = "contract_number {}, contract_name string, room_type string, characteristic string, board string"
    ours = spark.createDataFrame(
        [(1, "c", "R", "A", "BB", 2.5), (1, "c", "R", "A", "HB", 10.0), (2, "c", "R", "A", "BB", 7.0)],
        key.format("int") + ", price double")
    api = spark.createDataFrame(
        [("1", "c", "R", "A", "BB", 2.0)] * 2 + [("1", "c", "R", "A", "HB", 11.0)], key.format("string") + ", amount double")
    differs = rec.reconcile(ours, api).collect()
    assert [(r.board, r.difference) for r in differs] == [("HB", 1.0)]  # 2.5 rounds to the even 2
    assert rec.price_check(ours, api).count() == 2
    # several answers under the keys of an offer: it agrees if any of them does, and stands next to the nearest
    more = api.union(spark.createDataFrame([("1", "c", "R", "A", "HB", 10.4), ("1", "c", "R", "A", "BB", 50.0)], api.schema))
    assert rec.reconcile(ours, more).count() == 0
    assert sorted((r.board, r.api_amount) for r in rec.price_check(ours, more).collect()) == [("BB", 2.0), ("HB", 10.4)]
    assert [r.contract_number for r in rec.missing_from_api(ours, api).collect()] == ["2"]


def test_keys(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    hashed = [r[0] for r in df.select(md5_key("x", "y")).collect()]
    assert hashed[0] == hashlib.md5(b"a.b").hexdigest()
    assert hashed[1] is None
    assert df.select(surrogate("x", "y")).first()[0] > 0
