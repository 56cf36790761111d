"""Entry points for callers: what a contract-pricing application asks for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv
from tariffloom.functions import pricing as px
from tariffloom.operators import availability
from tariffloom.operators import cache as cache_ops
from tariffloom.operators import fold
from tariffloom.operators.availability import ROOM
from tariffloom.operators.rule_list import searched_list
from tariffloom.params import Stay


def search(tables, stay: Stay) -> DataFrame:
    """Priced search over the dated contract prices: five prices per offer."""
    return fold.fold_prices(searched_list(tables, stay), stay)


def search_cache(cache: DataFrame, stay: Stay) -> DataFrame:
    """Priced search over a stored price cache: room and board price per offer and board."""
    return cache_ops.priced_offers(cache, stay)


def search_cache_rules(cache: DataFrame, tables, stay: Stay) -> DataFrame:
    """Priced search over a stored price cache with all rules: five prices per offer and rate.

    Headers, capacities and room prices come from the cache; only the rule tables are read besides.
    """
    return fold.fold_prices(searched_list(tables, stay, cache_ops.cached_rooms(cache, stay)), stay)


def search_requests(tables, requests: DataFrame, supplier_id: int = 5) -> DataFrame:
    """Room search for a table of requests (request_id, file_id, check_in, check_out, ages): one plan for all of them.

    Per request the rooms of its contract that are priced for every night and hold its party, with the price of the stay. Requests
    equal in all columns are searched once, others that share an id each by itself.
    """
    columns = ["request_id", "file_id", "check_in", "check_out", "ages"]
    hotels = tables.table("hotel_supplier").filter(F.col("supplier_id") == supplier_id)
    asked = requests.select(*columns).distinct().join(availability.sold_contracts(tables, hotels), "file_id")
    parties = availability.with_party(asked, F.col("ages")).select(
        "request_id", "file_id", "check_in", "check_out", "contract_name", "city_code", "paxes", "adults", "childes")
    found = availability.rooms_for_requests(
        tables.table("cnct"), parties, windows=availability.asked_windows(requests),
        rooms=tables.table("cnha").select(*ROOM, "max_pax", "max_children"))
    nightly = F.col("stay_amount").cast("double") / F.col("sum_nights")
    return found.filter(availability.fits(F.col("paxes"), F.col("childes"))).select(
        "request_id", *ROOM, "base_board", "is_price_per_pax", "stay_nights", "sum_nights", "stay_amount", "max_pax", "max_children",
        "contract_name", "city_code", "paxes", "adults", "childes",
        (px.room_total(nightly, F.col("is_price_per_pax"), F.col("paxes")) * F.col("stay_nights")).alias("price"),
    )


def discounts_for_stay(tables, check_in: dt.date, check_out: dt.date, age: int = 5) -> DataFrame:
    """Price rows that touch the stay, with the board rules naming their room that outlast it.

    ``age`` is handed through to the result.
    """
    lo, hi = F.lit(check_in), F.lit(check_out)
    prices = tables.table("cnct").filter(
        iv.overlaps(F.col("initial_date"), F.col("final_date"), lo, hi)
        & (F.col("initial_date") < hi) & (F.col("final_date") > lo)
    )
    rooms = tables.table("cnha").select(*ROOM)
    boards = tables.table("cnsr").filter(
        iv.covers_strictly(F.col("initial_date"), F.col("final_date"), lo, hi)
    ).select(*ROOM, F.col("is_per_pax").alias("cnsr_is_per_pax"))
    return prices.join(rooms, ROOM).join(boards, ROOM, "left").select(
        "file_id", "hotel_id", "initial_date", "final_date", "room_type", "characteristic", "is_price_per_pax",
        "cnsr_is_per_pax", "base_board", "amount", F.lit(age).alias("age"),
    )
