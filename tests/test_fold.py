"""Ordered price fold against a plain sequential calculation, branch by branch."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tariffloom.operators import fold, running
from tariffloom.params import Stay

STAY = Stay(dt.date(2018, 4, 20), dt.date(2018, 4, 24), (30, 30, 5), dt.date(2018, 4, 1))  # Friday to Monday
GUEST, GENERAL = "NCIF", "BKULMOEVG"
MASKS = {"all": [0, 1, 2, 3, 4, 5, 6], "weekend": [None] * 5 + [5, 6], "tuesday": [None, None, 2, None, None, None, None]}

SCHEMA = (
    "sad_name string, cnct_id string, file_id string, room_type string, characteristic string, base_board string, "
    "rest_nights int, paxes int, standard_capacity int, cnct_is_per_pax string, cnsr_is_per_pax string, rule_id bigint, "
    "week_days array<int>, service_base_price double, pax_base_price double, service_base_board_price double, "
    "pax_base_board_price double, sad_code string, `order` int, type string, application_type string, amount double, "
    "percentage double, times int"
)


def offer(oid, room_flag, board_flag, amount=100.0, board=12.0, paxes=3, capacity=2):
    return {
        "cnct_id": oid, "room_flag": room_flag, "board_flag": board_flag, "p": paxes, "c": capacity,
        "s1": amount if room_flag == "N" else 0.0, "g1": amount if room_flag == "Y" else 0.0,
        "sb1": board if board_flag == "N" else 0.0, "gb1": board if board_flag == "Y" else 0.0,
    }


def rule(oid, kind, app, amount=None, pct=None, order=1, code="D1", rule_id=1, times=1, mask="all"):
    return {"cnct_id": oid, "type": kind, "app": app, "amount": amount, "pct": pct, "order": order, "code": code,
            "rule_id": rule_id, "times": times, "mask": mask}


def as_list(spark, offers, rules):
    rows, by_id = [], {o["cnct_id"]: o for o in offers}

    def head(o):
        return ("F", "ROOM", "A", "BB", STAY.nights, o["p"], o["c"], o["room_flag"])

    for o in offers:
        rows.append(("cnsr", o["cnct_id"], *head(o), o["board_flag"], 0, MASKS["all"], o["s1"], o["g1"] / o["p"],
                     o["sb1"], o["gb1"], None, -100000, None, None, None, None, None))
        # the placeholder row of an offer without a discount must be ignored
        rows.append(("cnsu", o["cnct_id"], *head(o), None, None, None, None, None, None, None, None, None, None, None,
                     None, None, None))
    for r in rules:
        o = by_id[r["cnct_id"]]
        rows.append(("cnsu", r["cnct_id"], *head(o), None, r["rule_id"], MASKS[r["mask"]], None, None, None, None,
                     r["code"], r["order"], r["type"], r["app"], r["amount"], r["pct"], r["times"]))
    return spark.createDataFrame(rows, SCHEMA)


def days_of(r):
    nights = {5: 1, 6: 1, 0: 1, 1: 1}
    return 1 if r["app"] in "TU" else sum(nights.get(d, 0) for d in MASKS[r["mask"]] if d is not None)


def by_hand(o, rules):
    """One rule after the other, on four running totals."""
    n, p, c = STAY.nights, o["p"], o["c"]
    room, board = ("g" if o["room_flag"] == "Y" else "s"), o["board_flag"]
    t = {"s": o["s1"] * n, "g": o["g1"] * n, "sb": o["sb1"] * n, "gb": o["gb1"] * n}
    bkey = {"Y": "gb", "N": "sb", None: None}[board]
    last = {"room": 0.0, "board": 0.0}
    ordered = sorted(rules, key=lambda r: (r["order"] is None, r["order"] or 0, r["code"], r["rule_id"]))
    for r in ordered:
        d, k, app = days_of(r), r["times"], r["app"]
        if d == 0:
            continue
        a, pct = r["amount"] or 0.0, r["pct"] or 0.0
        if r["type"] in GUEST:
            if app in "BNTU":
                if a:
                    t[room] += a / p * d * k
                elif pct:
                    t[room] += pct / 100 * (o["g1"] / p if room == "g" else o["s1"] / c) * d * k
            if app in "RNTU" and bkey:
                if a:
                    t[bkey] += a / p * d * k
                elif pct:
                    t[bkey] += pct / 100 * (o["gb1"] / p if bkey == "gb" else o["sb1"] / c) * d * k
            if app == "A" and a:
                t[room] += ((a - o["g1"]) / p if room == "g" else a / p - o["s1"] / c) * d * k
            if app == "M" and a and bkey:
                change = {
                    ("g", "sb"): (a - o["g1"] + o["gb1"]) / p,
                    ("g", "gb"): a / p - o["g1"] / p + o["sb1"],
                    ("s", "sb"): a / p - o["g1"] / c + o["sb1"] / c,
                    ("s", "gb"): a / p - o["g1"] / c + o["gb1"],
                }[(room, bkey)]
                t[room] += change * d * k
        else:
            if app in "BNTU" and (a or pct):
                last["room"] = a * d if a else last["room"] * pct / 100
                t[room] += last["room"]
            if app in "RNTU" and bkey and (a or pct):
                last["board"] = a * d if a else last["board"] * pct / 100
                t[bkey] += last["board"]
            if app == "A" and a:
                t[room] = a * d
            if app == "M" and a and bkey:
                extra = {("g", "sb"): t["gb"] / p, ("g", "gb"): t["gb"], ("s", "sb"): t["sb"] / c, ("s", "gb"): t["sb"]}
                t[room] = (a + extra[(room, bkey)]) * d
    return t["s"], t["sb"], t["g"], t["gb"]


def check(spark, offers, rules, pieces=None):
    got = {r.cnct_id: r for r in fold.fold_prices(as_list(spark, offers, rules), STAY, pieces).collect()}
    assert set(got) == {o["cnct_id"] for o in offers}
    for o in offers:
        want = by_hand(o, [r for r in rules if r["cnct_id"] == o["cnct_id"]])
        row = got[o["cnct_id"]]
        have = (row.sbprice, row.sbbprice, row.pbprice, row.pbbprice)
        assert have == pytest.approx(want, abs=1e-9), (o, want, have)
        assert row.total_price == pytest.approx(sum(want), abs=1e-9)


def test_every_branch(spark):
    """One offer per family, application type, pair of flags, and amount or percentage."""
    offers, rules = [], []
    for i, (kind, app, room, board, by_amount) in enumerate(
        itertools.product("NB", "BNTURAM", "YN", ["Y", "N", None], [True, False])
    ):
        oid = f"o{i}"
        offers.append(offer(oid, room, board))
        value = {"amount": 9.0} if by_amount else {"pct": -7.0}
        rules.append(rule(oid, kind, app, order=2, code="D2", times=2 if kind == "N" else 1, **value))
        # an earlier general amount gives percentages something to chain on
        rules.append(rule(oid, "K", "N", amount=5.0, order=1, code="D1", rule_id=2))
    check(spark, offers, rules)


def test_hand_values(spark):
    """Fixed numbers: 4 nights, room 100 per guest flag, one general amount then a percentage of it."""
    offers = [offer("x", "Y", "Y"), offer("y", "Y", "Y"), offer("z", "N", "N")]
    rules = [
        rule("x", "B", "B", amount=10.0, order=1), rule("x", "B", "B", pct=50.0, order=2, code="D2", rule_id=2),
        rule("y", "B", "B", pct=50.0, order=1), rule("y", "B", "B", amount=10.0, order=2, code="D2", rule_id=2),
        rule("z", "B", "A", amount=7.0, order=2), rule("z", "B", "B", amount=10.0, order=1, code="D2", rule_id=2),
    ]
    got = {r.cnct_id: r for r in fold.fold_prices(as_list(spark, offers, rules), STAY).collect()}
    assert got["x"].pbprice == pytest.approx(400 + 40 + 20)  # amount, then half of it
    assert got["y"].pbprice == pytest.approx(400 + 0 + 40)   # half of nothing, then the amount
    assert got["z"].sbprice == pytest.approx(28)             # the absolute price replaces what came before
    assert (got["x"].pbbprice, got["z"].sbbprice) == (48.0, 48.0)


@pytest.mark.parametrize("pieces", [None, 1, 7])
def test_long_lists_split_over_partitions(spark, pieces):
    """One offer holds most rules; its list is cut anywhere and must fold the same."""
    rnd = random.Random(3)
    offers = [offer("hot", "Y", "Y"), offer("cold", "N", "N"), offer("bare", "N", "Y")]
    rules = []
    for i in range(160):
        oid = "hot" if i % 8 else "cold"
        by_amount = rnd.random() < 0.6
        rules.append(rule(
            oid, rnd.choice(GUEST + GENERAL), rnd.choice("BNTURAM"),
            amount=round(rnd.uniform(-5, 5), 2) if by_amount else None,
            pct=None if by_amount else rnd.choice([-5.0, 10.0, 0.0]),
            order=rnd.choice([None, 1, 2, 3, 4]), code=f"D{rnd.randint(0, 4)}", rule_id=i,
            times=rnd.randint(1, 2), mask=rnd.choice(list(MASKS)),
        ))
    check(spark, offers, rules, pieces)


def test_guest_rules_do_not_depend_on_order(spark):
    rnd = random.Random(5)
    offers = [offer("a", "N", "Y"), offer("b", "N", "Y")]
    terms = [(rnd.choice(GUEST), rnd.choice("BNTURAM"), round(rnd.uniform(1, 9), 2)) for _ in range(12)]
    rules = [rule("a", k, p, amount=v, order=i, rule_id=i) for i, (k, p, v) in enumerate(terms)]
    rules += [rule("b", k, p, amount=v, order=99 - i, rule_id=i) for i, (k, p, v) in enumerate(terms)]
    got = {r.cnct_id: r for r in fold.fold_prices(as_list(spark, offers, rules), STAY).collect()}
    assert got["a"].total_price == pytest.approx(got["b"].total_price)


def states_by_hand(o, rules):
    """The four prices after the base row and after each rule, by folding every beginning of the list."""
    priced = sorted([r for r in rules if days_of(r)], key=lambda r: (r["order"] is None, r["order"] or 0, r["code"], r["rule_id"]))
    return [by_hand(o, priced[:k]) for k in range(len(priced) + 1)]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_running_price_is_every_beginning_of_the_fold(spark, coalesce):
    """General and guest rules; one offer holds most of them, so that it spans pieces where Spark doesn't put them together."""
    rnd = random.Random(8)
    offers = [offer("a", "N", "Y"), offer("b", "Y", "N"), offer("hot", "Y", "Y"), offer("bare", "N", None)]
    rules = [rule(rnd.choice(["a", "b", "hot", "hot", "hot"]), rnd.choice(GUEST + GENERAL), rnd.choice("BNTURAM"), order=rnd.choice([None, 1, 2, 3]),
                  code=f"D{i % 3}", rule_id=i, times=rnd.randint(1, 2), mask=rnd.choice(list(MASKS)),
                  **({"amount": round(rnd.uniform(-5, 5), 2)} if i % 2 else {"pct": rnd.choice([-5.0, 10.0])})) for i in range(150)]
    listed = as_list(spark, offers, rules)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        rows = running.running_price(listed, STAY).orderBy("_at").collect()
        ends = {r.cnct_id: r for r in fold.fold_prices(listed, STAY).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for o in offers:
        mine = [(r.service_base_price, r.service_base_board_price, r.pax_base_price, r.pax_base_board_price) for r in rows if r.cnct_id == o["cnct_id"]]
        want = states_by_hand(o, [r for r in rules if r["cnct_id"] == o["cnct_id"]])
        assert len(mine) == len(want)
        for have, should in zip(mine, want):
            assert have == pytest.approx(should, abs=1e-9)
        end = ends[o["cnct_id"]]
        assert mine[-1] == pytest.approx((end.sbprice, end.sbbprice, end.pbprice, end.pbbprice), abs=1e-9)


def test_base_rows_add_up_board_prices(spark):
    listed = as_list(spark, [offer("a", "N", "Y"), offer("a", "N", "Y", board=5.0)], [])
    got = [r.pax_base_board_price for r in running.running_price(listed, STAY).orderBy("_at").collect()]
    assert got == pytest.approx([5.0 * 4, 17.0 * 4])


def test_superseded_rules_of_one_hot_offer(spark):
    """Neighbours are the next rows of the same guest, also over the cuts between pieces."""
    rnd = random.Random(11)
    day = dt.date(2018, 1, 1)
    rows = [(rnd.choice(["hot", "hot", "hot", "cold"]), [1, 2][: 1 + i % 2], None, "D1", i, rnd.choice("NK"), "B", day + dt.timedelta(days=rnd.randint(0, 5)), 1.0, None)
            for i in range(400)]
    df = spark.createDataFrame(rows, "cnct_id string, pax_ids array<int>, `order` int, sad_code string, rule_id long, type string, application_type string, "
                               "application_initial_date date, sad_amount double, sad_percentage double").repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.cnct_id, r.pax_id, r.rule_id): r.sad_status for r in running.superseded_rules(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for oid in ("hot", "cold"):
        for pax in (1, 2):
            mine = [r for r in rows if r[0] == oid and pax in r[1]]
            for i, r in enumerate(mine):
                near = ([mine[i - 1]] if i else []) + mine[i + 1:i + 2]
                assert got.pop((oid, pax, r[4])) == int(not any(n[5] == r[5] and n[7] > r[7] for n in near))
    assert not got
