"""Rule matching and the dictionary joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import predicates as pr
from tariffloom.functions.keys import md5_key, money
from tariffloom.operators import availability as av
from tariffloom.operators import rooms, rules, running, terms
from tariffloom.operators.matching import match_rules
from tariffloom.plans.common import FAMILY, ids, query


@query
def wildcard_rule_match(t) -> DataFrame:
    """Discount rules that reach a room by name or by wildcard."""
    found = av.available_rooms(t.table("cnct"), FAMILY)
    candidates = rules.dated(t.table("cnsu"), FAMILY).select(*av.ROOM, "rule_id", "code")
    return match_rules(found, candidates).select("file_id", "room_type", "characteristic", "rule_id", "code")


@query
def rate_match(t) -> DataFrame:
    """Board rules by rate: both missing, equal, or a rule without one."""
    key = (*av.ROOM, "rate")
    prices = t.table("cnct").withColumn("rate", F.coalesce("generic_rate", "specific_rate"))
    found = av.available_rooms(prices, FAMILY, key)
    matched = match_rules(
        found, rules.board_candidates(t.table("cnsr"), FAMILY), pr.rate_match(F.col("cnsr_rate"), F.col("rate"))
    )
    return matched.select(*key, "rule_id", "board_code")


@query
def booking_window(t) -> DataFrame:
    """Discount rules that can be booked on the booking date."""
    return rules.bookable(t.table("cnsu"), FAMILY).select("file_id", "rule_id", "code", "type")


@query
def rule_eligibility(t) -> DataFrame:
    """Discounts with the guests they meet, by rule type."""
    matched = rules.discount_rules(av.offers(t, FAMILY), t.table("cnsu"), FAMILY, how="inner")
    return matched.select("cnct_id", "rule_id", "sad_code", "type", ids("pax_ids").alias("guests_met"), "times")


@query
def board_rules(t) -> DataFrame:
    """Board rules of every offer; offers without one stay."""
    matched = rules.board_rules(av.offers(t, FAMILY), t.table("cnsr"), FAMILY)
    return matched.select(
        "cnct_id", F.coalesce("rule_id", F.lit(-1)).alias("rule_id"),
        F.coalesce("board_code", F.lit("")).alias("board_code"), F.coalesce("billed", F.lit(0)).alias("billed"),
    )


@query
def board_rules_inner(t) -> DataFrame:
    """Board rules as a condition: offers without one go."""
    matched = rules.board_rules(av.offers(t, FAMILY), t.table("cnsr"), FAMILY, how="inner")
    return matched.select(
        "contract_number", "room_type", "characteristic",
        F.concat("base_board", F.lit("-"), "board_code").alias("meal_type"), "rule_id", "cnsr_is_per_pax",
        ids("pax_ids").alias("guests_met"),
    )


@query
def discount_rules(t) -> DataFrame:
    """Supplements and discounts of every offer; offers without one stay."""
    matched = rules.discount_rules(av.offers(t, FAMILY), t.table("cnsu"), FAMILY)
    return matched.select(
        "cnct_id", F.coalesce("rule_id", F.lit(-1)).alias("rule_id"),
        F.coalesce("sad_code", F.lit("")).alias("sad_code"), F.coalesce("order", F.lit(-1)).alias("order"),
        F.coalesce("application_type", F.lit("")).alias("application_type"),
        F.coalesce("times", F.lit(0)).alias("times"),
    )


@query
def free_night_rules(t) -> DataFrame:
    """Free-night rules of every offer; offers without one stay."""
    matched = rules.free_night_rules(av.offers(t, FAMILY), t.table("cngr"), FAMILY)
    return matched.select(
        "cnct_id", F.coalesce("rule_id", F.lit(-1)).alias("rule_id"),
        F.coalesce("sad_code", F.lit("")).alias("free_code"), F.coalesce("frees", F.lit(0)).alias("frees"),
    )


@query
def stay_length_rules(t) -> DataFrame:
    """Offers with the stay rules that allow the stay."""
    matched = rules.stay_length_rules(av.offers(t, FAMILY), t.table("cnem"), FAMILY)
    return matched.select(
        "cnct_id", F.coalesce("rule_id", F.lit(-1)).alias("rule_id"),
        F.coalesce("minimum_days", F.lit(0)).alias("minimum_days"),
        F.coalesce("maximum_days", F.lit(0)).alias("maximum_days"),
    )


@query
def min_nights_rule(t) -> DataFrame:
    """Minimum nights of every stay rule: missing or zero days ask for nothing, others for one night less."""
    days = F.coalesce("minimum_days", F.lit(0))
    return t.table("cnem").select(
        "file_id", "rule_id", F.when(days == 0, F.lit(0)).otherwise(days - 1).alias("min_nights")
    )


@query
def superseded_rules(t) -> DataFrame:
    """Discounts replaced by a neighbour announced later."""
    matched = rules.discount_rules(av.offers(t, FAMILY), t.table("cnsu"), FAMILY, how="inner")
    flagged = running.superseded_rules(matched)
    return flagged.withColumn("order", F.coalesce("order", F.lit(-1)))


@query
def or_join(t) -> DataFrame:
    """What the three-way OR join does to each price row."""
    joined = rooms.or_join(t.table("cnct"), t.table("cnsu"))
    return joined.select("id", "rules", "copies", money(F.col("rule_amount")).alias("rule_amount"))


@query
def prefix_join(t) -> DataFrame:
    """Part names against room-type names by prefix."""
    parts = t.shared("part").select("p_partkey", F.upper("p_name").alias("description"))
    joined = rooms.prefix_join(parts, "description", t.table("room_type_names"), "name_en")
    return joined.select("p_partkey", "description", F.coalesce("name_en", F.lit("")).alias("name_en"))


@query
def room_types(t) -> DataFrame:
    """Rooms with their description and accommodation type."""
    out = rooms.room_types(t.table("cnha"), t.table("rt_dic"), t.table("room_type_names"))
    return out.select(
        "rt_id", "file_id", "room_type", "characteristic", "description",
        F.coalesce("accommodation_type", F.lit("")).alias("accommodation_type"), "standard_capacity", "max_pax",
    )


@query
def pair_rule_lookup(t) -> DataFrame:
    """First codes of the pair rules, looked up per available room."""
    coded, lists = terms.as_dictionary(terms.counted_codes(t.table("cnoe"), ["file_id"], "code1", "cnoe_code1"), "cnoe_code1")
    # rooms carry the id of their contract's list; texts are met last, one row a list
    found = av.available_rooms(t.table("cnct"), FAMILY).select(*av.ROOM).join(coded, "file_id", "left")
    return found.join(lists, "cnoe_code1_id", "left").select(
        "file_id", "room_type", "characteristic", F.coalesce("cnoe_code1", F.lit("")).alias("cnoe_code1")
    )


@query
def md5_key_join(t) -> DataFrame:
    """Rooms joined to their capacity by a hashed key."""
    found = av.available_rooms(t.table("cnct"), FAMILY).withColumn("cnct_id", md5_key(*av.ROOM))
    capacity = t.table("cnha").select(md5_key(*av.ROOM).alias("cnct_id"), "standard_capacity", "max_pax")
    return found.join(capacity, "cnct_id").select("cnct_id", "sum_nights", "standard_capacity", "max_pax")


@query
def offer_capacity(t) -> DataFrame:
    """Rooms joined to their capacity by contract, room and characteristic."""
    found = av.available_rooms(t.table("cnct"), FAMILY)
    return found.join(t.table("cnha").drop("hotel_id"), av.ROOM).select(
        *av.ROOM, "sum_nights", "standard_capacity", "min_pax", "max_pax", "max_adult", "max_children"
    )


def _rooms_with_id(t) -> DataFrame:
    return av.available_rooms(t.table("cnct"), FAMILY).select(
        md5_key("file_id", "room_type", "characteristic", "base_board").alias("id"),
        "file_id", "room_type", "characteristic", "base_board",
        F.concat_ws(",", F.sort_array(F.array("room_type", "base_board"))).alias("combination"),
    )


def _representatives(found: DataFrame) -> DataFrame:
    """One id per contract and combination: a minimum, so no window holds a whole contract."""
    return found.groupBy("file_id", "combination").agg(F.min("id").alias("representative"))


@query
def first_value_window(t) -> DataFrame:
    """First room of every combination of room and board in a contract."""
    return _representatives(_rooms_with_id(t))


@query
def array_member_join(t) -> DataFrame:
    """Rooms that are a member of their contract's list of chosen ids.

    The lists are inverted: one row a member, met on contract and id, so no list stands on any row and a contract of any size is spread.
    """
    found = _rooms_with_id(t)
    members = _representatives(found).select("file_id", F.col("representative").alias("id")).distinct()
    return found.join(members, ["file_id", "id"], "left_semi").distinct()


QUERIES = {
    "wildcard_rule_match": wildcard_rule_match,
    "rate_match": rate_match,
    "booking_window": booking_window,
    "rule_eligibility": rule_eligibility,
    "board_rules": board_rules,
    "board_rules_inner": board_rules_inner,
    "discount_rules": discount_rules,
    "free_night_rules": free_night_rules,
    "stay_length_rules": stay_length_rules,
    "min_nights_rule": min_nights_rule,
    "superseded_rules": superseded_rules,
    "or_join": or_join,
    "prefix_join": prefix_join,
    "room_types": room_types,
    "pair_rule_lookup": pair_rule_lookup,
    "md5_key_join": md5_key_join,
    "offer_capacity": offer_capacity,
    "first_value_window": first_value_window,
    "array_member_join": array_member_join,
}
