"""The four rule families of a contract, matched to offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv
from tariffloom.functions import predicates as pr
from tariffloom.functions.pricing import GUEST_TYPES
from tariffloom.functions.weekdays import weekday_mask
from tariffloom.operators.matching import keep_unmatched, match_rules
from tariffloom.params import Stay
from tariffloom.sources.sinks import stored


def dated(rules: DataFrame, stay: Stay) -> DataFrame:
    """Rules whose validity overlaps the stay. The first filter is what every overlap implies, also with reversed
    ends, in the plain form a scan can skip row groups by; the exact test follows."""
    a, b = F.col("initial_date"), F.col("final_date")
    near = ((a <= stay.hi) | (b <= stay.hi)) & ((a >= stay.lo) | (b >= stay.lo))
    return rules.filter(near).filter(iv.overlaps(a, b, stay.lo, stay.hi))


def bookable(rules: DataFrame, stay: Stay) -> DataFrame:
    return rules.filter(
        iv.open_window(F.col("application_initial_date"), F.col("application_final_date"), stay.now)
    )


def once(offers: DataFrame, how: str) -> DataFrame:
    """A left match reads the offers three times: they are stored, so that the price rows behind them are read once."""
    return stored(offers) if how == "left" else offers


def _ids(guests: Column, member) -> Column:
    return F.transform(F.filter(guests, member), lambda g: g["pax_id"])


# --- boards ---------------------------------------------------------------------------------------------------


def board_candidates(cnsr: DataFrame, stay: Stay) -> DataFrame:
    return dated(cnsr, stay).select(
        "file_id", "room_type", "characteristic", "rule_id", "board_code",
        F.col("is_per_pax").alias("cnsr_is_per_pax"),
        F.col("amount").cast("double").alias("cnsr_amount"),
        F.col("percentage").cast("double").alias("cnsr_percentage"),
        F.col("min_age").alias("cnsr_min_age"), F.col("max_age").alias("cnsr_max_age"),
        F.col("rate").alias("cnsr_rate"),
        weekday_mask().alias("week_days"),
    )


def board_rules(offers: DataFrame, cnsr: DataFrame, stay: Stay, how: str = "left") -> DataFrame:
    """Board rules of each offer; one guest has to satisfy both age bounds.

    ``pax_ids`` are the guests inside the age band (every guest when there is none), ``billed`` how many pay.
    """
    offers = once(offers, how)
    matched = match_rules(offers, board_candidates(cnsr, stay))
    lo, hi = F.col("cnsr_min_age"), F.col("cnsr_max_age")
    banded = lo.isNotNull() | hi.isNotNull()
    matched = (
        matched.withColumn("pax_ids", _ids(F.col("guests"), lambda g: pr.in_band(g["age"], lo, hi)))
        .filter(F.size("pax_ids") > 0)
        .withColumn("billed", F.when(banded, F.size("pax_ids")).otherwise(F.col("paxes")))
    )
    return keep_unmatched(offers, matched) if how == "left" else matched


# --- supplements and discounts --------------------------------------------------------------------------------


def discount_candidates(cnsu: DataFrame, stay: Stay) -> DataFrame:
    return bookable(dated(cnsu, stay), stay).select(
        "file_id", "room_type", "characteristic", "rule_id",
        F.col("board").alias("rule_board"), F.col("code").alias("sad_code"), "order", "type", "application_type",
        F.col("amount").cast("double").alias("sad_amount"),
        F.col("percentage").cast("double").alias("sad_percentage"),
        F.col("is_per_pax").alias("cnsu_is_per_pax"), F.col("is_cumulative").alias("cnsu_is_cumulative"),
        F.col("adults").alias("rule_adults"), "pax_order",
        F.col("min_age").alias("rule_min_age"), F.col("max_age").alias("rule_max_age"),
        "application_initial_date",
        weekday_mask().alias("week_days"),
    )


def eligible_guests(kind: Column, pax_order: Column, lo: Column, hi: Column, guests: Column) -> Column:
    """Guests a rule meets: the n-th child or infant inside the age band, else everybody."""

    def nth(field: str):
        return lambda g: F.coalesce(g[field] == pax_order, F.lit(False)) & pr.in_band(g["age"], lo, hi)

    return (
        F.when(kind == "N", _ids(guests, nth("child_id")))
        .when(kind == "F", _ids(guests, nth("infant_id")))
        .otherwise(F.transform(guests, lambda g: g["pax_id"]))
    )


def rule_applies(kind: Column, capacity: Column, paxes: Column, pax_ids: Column) -> Column:
    """Conditional predicate by rule type."""
    return (
        F.when(kind.isin("N", "F"), F.size(pax_ids) > 0)
        .when(kind == "C", capacity < paxes)
        .otherwise(F.lit(True))
    )


def discount_rules(offers: DataFrame, cnsu: DataFrame, stay: Stay, how: str = "left") -> DataFrame:
    """Supplement and discount rules of each offer. ``times`` is how often a rule counts: once per matching guest
    for guest types, once per offer for general types."""
    offers = once(offers, how)
    matched = match_rules(
        offers,
        discount_candidates(cnsu, stay),
        pr.wildcard_match(F.col("rule_board"), F.col("base_board"))
        & (F.col("rule_adults").isNull() | (F.col("rule_adults") <= F.col("adults"))),
    )
    kind = F.col("type")
    matched = (
        matched.withColumn(
            "pax_ids",
            eligible_guests(kind, F.col("pax_order"), F.col("rule_min_age"), F.col("rule_max_age"), F.col("guests")),
        )
        .filter(rule_applies(kind, F.col("standard_capacity"), F.col("paxes"), F.col("pax_ids")))
        .withColumn("times", F.when(kind.isin(*GUEST_TYPES), F.size("pax_ids")).otherwise(F.lit(1)))
    )
    return keep_unmatched(offers, matched) if how == "left" else matched


# --- free nights ----------------------------------------------------------------------------------------------


def free_night_rules(offers: DataFrame, cngr: DataFrame, stay: Stay, how: str = "left") -> DataFrame:
    candidates = bookable(dated(cngr, stay), stay).filter(
        pr.stay_length_strict(F.col("min_days"), F.col("max_days"), stay.nights)
    ).select(
        "file_id", "room_type", "characteristic", "rule_id", F.col("board").alias("rule_board"),
        "frees", F.col("free_code").alias("sad_code"), F.col("discount").cast("double").alias("discount"),
        "application_base_type", "application_board_type", "application_discount_type", "application_stay_type",
        weekday_mask().alias("week_days"),
    )
    offers = once(offers, how)
    matched = match_rules(offers, candidates, pr.wildcard_match(F.col("rule_board"), F.col("base_board")))
    return keep_unmatched(offers, matched) if how == "left" else matched


# --- minimum and maximum stay ---------------------------------------------------------------------------------


def stay_length_rules(offers: DataFrame, cnem: DataFrame, stay: Stay) -> DataFrame:
    """Offers with the stay rules that allow the stay, plus offers without any stay rule."""
    candidates = (
        cnem.filter(iv.covers(F.col("initial_date"), F.col("final_date"), stay.lo, stay.hi))
        .filter(F.col("application_date").isNull() | (F.col("application_date") < stay.now))
        .select("file_id", "room_type", "characteristic", "rule_id", F.col("board").alias("rule_board"),
                "minimum_days", "maximum_days")
    )
    offers = once(offers, "left")
    matched = match_rules(offers, candidates, pr.wildcard_match(F.col("rule_board"), F.col("base_board")))
    return keep_unmatched(offers, matched).filter(
        pr.stay_length_open(F.col("minimum_days"), F.col("maximum_days"), stay.nights)
    )
