"""Rule matching against brute force, with crowded keys split over buckets."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tariffloom.operators import matching

ROOMS = ["SMALL", "LARGE", "SUITE"]
CHARS = ["A", "N"]


def fixture(spark, seed=7, n_rules=400):
    rnd = random.Random(seed)
    # contract S0 holds most rules and most offers
    offers = [
        (f"o{i}", "S0" if rnd.random() < 0.6 else f"S{rnd.randint(1, 4)}", rnd.choice(ROOMS), rnd.choice(CHARS))
        for i in range(60)
    ]
    rules = [
        (i, "S0" if rnd.random() < 0.6 else f"S{rnd.randint(1, 5)}", rnd.choice([*ROOMS, "", None, None]),
         rnd.choice([*CHARS, "", None]), rnd.randint(0, 9))
        for i in range(n_rules)
    ]
    o = spark.createDataFrame(offers, "cnct_id string, file_id string, room_type string, characteristic string")
    r = spark.createDataFrame(
        rules, "rule_id bigint, file_id string, room_type string, characteristic string, weight int"
    )
    pairs = {
        (oid, rid)
        for oid, of, oroom, ochar in offers
        for rid, rf, rroom, rchar, w in rules
        if of == rf and rroom in (None, "", oroom) and rchar in (None, "", ochar) and w > 2
    }
    return o, r, offers, pairs


def test_match_equals_brute_force(spark):
    o, r, _, pairs = fixture(spark)
    for per_bucket in (4096, 5):
        got = matching.match_rules(o, r, F.col("weight") > 2, per_bucket=per_bucket)
        rows = [(x.cnct_id, x.rule_id) for x in got.select("cnct_id", "rule_id").collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == pairs


def test_every_crowded_key_is_split(spark):
    rules = spark.range(30_000).selectExpr(
        "id as rule_id", "concat('S', id % 3000) as file_id", "'' as room_type", "'' as characteristic")
    crowded = matching.crowded_keys(matching.keyed_rules(rules), matching.KEYS, per_bucket=4)
    rows = crowded.collect()
    assert len(rows) == 3000 and {r.buckets for r in rows} == {3}
    offers = spark.range(3000).selectExpr("id as cnct_id", "concat('S', id) as file_id", "'R' as room_type", "'' as characteristic")
    assert matching.match_rules(offers, rules, per_bucket=4).select("cnct_id", "rule_id").distinct().count() == 30_000


def test_blank_rooms_meet_a_rule_once(spark):
    offers = spark.createDataFrame(
        [("a", "S", "", ""), ("b", "S", "", "N"), ("c", "S", None, "N"), ("d", "S", "R", "N")],
        "cnct_id string, file_id string, room_type string, characteristic string")
    rules = spark.createDataFrame(
        [(1, "S", "", None), (2, "S", None, "N"), (3, "S", "R", "")],
        "rule_id bigint, file_id string, room_type string, characteristic string")
    got = sorted((r.cnct_id, r.rule_id) for r in matching.match_rules(offers, rules).select("cnct_id", "rule_id").collect())
    assert got == [("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", 2), ("d", 1), ("d", 2), ("d", 3)]


def test_unmatched_offers_stay(spark):
    o, r, offers, pairs = fixture(spark, n_rules=15)
    matched = matching.match_rules(o, r, F.col("weight") > 2)
    kept = matching.keep_unmatched(o, matched).select("cnct_id", "rule_id").collect()
    lonely = {x[0] for x in offers} - {p[0] for p in pairs}
    assert lonely
    assert {x.cnct_id for x in kept if x.rule_id is None} == lonely
    assert {(x.cnct_id, x.rule_id) for x in kept if x.rule_id is not None} == pairs


def test_wildcards_need_no_nested_loop(spark):
    o, r, _, _ = fixture(spark)
    plan = matching.match_rules(o, r)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
