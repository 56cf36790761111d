"""Whole pipelines: cache, rule list, price fold."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions.keys import money
from tariffloom.operators import availability as av
from tariffloom.operators import cache as cache_ops
from tariffloom.operators import rule_list, running, terms
from tariffloom.plans.common import COUPLE, FAMILY, flat_range, ids, query
from tariffloom.search import discounts_for_stay, search, search_cache, search_cache_rules, search_requests
from tariffloom.sources.sinks import read_cache, stored_root, write_cache

PRICES = ("sbprice", "sbbprice", "pbprice", "pbbprice", "total_price")


@query
def cache_build(t) -> DataFrame:
    """The price cache: base boards and supplementary boards."""
    plain = [
        "file_id", "rt_id", "country_code", "city_code", "hotel_code", "contract_name", "contract_number",
        "room_type_id", "meal_type", "room_type", "characteristic", "rate", "board", "cnsr_amount",
        "cnsr_percentage", "cnsr_is_per_pax", "lo", "hi", "currency_code", "adult_price", "child_price", "amount",
        "is_price_per_pax", "min_nights", *cache_ops.CAPACITY,
    ]
    return cache_ops.build_cache(t).select(*plain, flat_range("childe_ages"), flat_range("cnsr_pax_ages"))


@query
def nightly_cache(t) -> DataFrame:
    """The first cache: single nights with their price and minimum stay."""
    return cache_ops.build_nightly_cache(t)


def _list(t) -> DataFrame:
    return rule_list.rule_list(av.offers(t, FAMILY), t, FAMILY)


def _shown(listed: DataFrame) -> DataFrame:
    text = ("cnsr_is_per_pax", "sad_code", "type", "application_type", "cnsu_is_per_pax", "cnsu_is_cumulative",
            "application_base_type", "application_board_type", "application_discount_type", "application_stay_type")
    money_cols = ("service_base_price", "pax_base_price", "service_base_board_price", "pax_base_board_price", "amount",
                  "percentage", "discount")
    return listed.select(
        "sad_name", "cnct_id", "file_id", "room_type", "characteristic", "base_board", "rest_nights", "paxes", "adults",
        "childes", "infants", "standard_capacity", "max_pax", "max_children", "cnct_is_per_pax",
        F.coalesce("rule_id", F.lit(-1)).alias("rule_id"), ids("pax_ids").alias("guests_met"),
        F.coalesce(F.array_join("week_days", ",", "-"), F.lit("")).alias("week_days"),
        F.coalesce("order", F.lit(-1)).alias("order"), F.coalesce("frees", F.lit(0)).alias("frees"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in text],
        *[money(F.coalesce(c, F.lit(0.0))).alias(c) for c in money_cols],
    )


@query
def rule_union(t) -> DataFrame:
    """Base rows, discounts and free nights of every offer in one list."""
    return _shown(rule_list.carry_board_flag(_list(t)))


@query
def rule_order(t) -> DataFrame:
    """The list in pricing order, missing orders last. A global sort is range-partitioned, so offers may span tasks."""
    ordered = _list(t).orderBy(
        "cnct_id", F.col("order").asc_nulls_last(), F.col("sad_code").asc_nulls_last(), F.col("rule_id").asc_nulls_last()
    )
    return ordered.select(
        "cnct_id", "sad_name", F.coalesce("order", F.lit(-1)).alias("order"),
        F.coalesce("sad_code", F.lit("")).alias("sad_code"), F.coalesce("rule_id", F.lit(-1)).alias("rule_id"),
    )


@query
def offer_code_list(t) -> DataFrame:
    """Every code of an offer, in order."""
    return terms.counted_codes(_list(t), ["cnct_id"], "sad_code", "sad_list")


@query
def drop_incompatible(t) -> DataFrame:
    """The list without the codes that pair rules rule out."""
    left = rule_list.searched_list(t, FAMILY)
    return left.select(
        "cnct_id", "sad_name", F.coalesce("sad_code", F.lit("")).alias("sad_code"),
        F.coalesce("rule_id", F.lit(-1)).alias("rule_id"),
    )


@query
def price_fold(t) -> DataFrame:
    """Priced search: five prices per offer after all rules, in order."""
    prices = search(t, FAMILY)
    return prices.select(
        "cnct_id", "file_id", "room_type", "characteristic", "board", *[money(F.col(c)).alias(c) for c in PRICES]
    )


def _written_cache(t) -> DataFrame:
    """The cache as it is used: written by country and city, read back with its declared schema."""
    spark = t.table("cnct").sparkSession
    path = f"{stored_root(spark)}/cache-{uuid.uuid4().hex}"
    write_cache(cache_ops.build_cache(t, by_city=True), path, by_city=True)
    return read_cache(spark, path)


@query
def cached_price_fold(t) -> DataFrame:
    """Priced search with all rules over a written cache, for one city prefix."""
    stay = replace(FAMILY, city_prefix="NATION_1")
    prices = search_cache_rules(_written_cache(t), t, stay)
    return prices.select(
        "cnct_id", "file_id", "room_type", "characteristic", "board", *[money(F.col(c)).alias(c) for c in PRICES]
    )


@query
def running_price(t) -> DataFrame:
    """Prices of an offer after each row of its list: base rows, then every priced rule in order."""
    run = running.running_price(rule_list.searched_list(t, FAMILY), FAMILY)
    return run.select(
        "cnct_id", "sad_name", F.coalesce("order", F.lit(-1)).alias("order"), F.coalesce("sad_code", F.lit("")).alias("sad_code"),
        F.coalesce("rule_id", F.lit(-1)).alias("rule_id"), F.coalesce("type", F.lit("")).alias("type"),
        F.coalesce("application_type", F.lit("")).alias("application_type"), *[money(F.col(c)).alias(c) for c in running.PRICES],
    )


def _cached(t, stay) -> DataFrame:
    found = search_cache(cache_ops.build_cache(t), stay)
    return found.select(
        "file_id", "rt_id", "city_code", "room_type", "characteristic", F.coalesce("rate", F.lit("")).alias("rate"), "board", "sum_nights", "terms",
        money(F.col("room_price")).alias("room_price"), money(F.col("board_price")).alias("board_price"),
        money(F.col("price")).alias("price"),
    )


@query
def cached_search(t) -> DataFrame:
    """Priced search over the cache for one city prefix."""
    return _cached(t, COUPLE)


@query
def cached_search_family(t) -> DataFrame:
    """The same for two adults, a child and an infant, in any city."""
    return _cached(t, FAMILY)


@query
def requested_rooms(t) -> DataFrame:
    """Rooms and prices for every booking request, in one plan."""
    found = search_requests(t, t.requests())
    return found.select(
        "request_id", "file_id", "city_code", "room_type", "characteristic", "base_board", "is_price_per_pax", "sum_nights",
        F.col("stay_amount").cast("double").alias("stay_amount"), "paxes", "adults", "childes", money(F.col("price")).alias("price"),
    )


@query
def discounts_of_stay(t) -> DataFrame:
    """Price rows of the stay with the board rules that outlast it."""
    out = discounts_for_stay(t, FAMILY.check_in, FAMILY.check_out)
    return out.withColumn("cnsr_is_per_pax", F.coalesce("cnsr_is_per_pax", F.lit("")))


@query
def rule_passthrough(t) -> DataFrame:
    """The first hundred discount rules, unchanged; ordered, so the hundred are always the same."""
    return t.table("cnsu").select(
        "file_id", "rule_id", "code", "type", "application_type", "pax_order", "initial_date", "final_date"
    ).orderBy("file_id", "rule_id", "code", "initial_date").limit(100)


QUERIES = {
    "cache_build": cache_build,
    "nightly_cache": nightly_cache,
    "rule_union": rule_union,
    "rule_order": rule_order,
    "offer_code_list": offer_code_list,
    "drop_incompatible": drop_incompatible,
    "price_fold": price_fold,
    "cached_price_fold": cached_price_fold,
    "running_price": running_price,
    "cached_search": cached_search,
    "cached_search_family": cached_search_family,
    "search_requests": requested_rooms,
    "discounts_for_stay": discounts_of_stay,
    "rule_passthrough": rule_passthrough,
}
