"""The price cache: one row per dated room price and board, with everything a search filters on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv
from tariffloom.functions import predicates as pr
from tariffloom.functions import pricing as px
from tariffloom.functions.keys import md5_key
from tariffloom.operators import interval_join as bins
from tariffloom.operators.availability import ROOM, ROOM_KEY, by_night, fits, fully_covered, night_words, sold_contracts, sold_rooms, with_party
from tariffloom.operators.matching import match_rules
from tariffloom.params import Stay

CAPACITY = [
    "standard_capacity", "min_pax", "max_pax", "max_adult", "max_children", "max_infant", "min_adult", "min_children",
]


def rooms_of_supplier(tables, supplier_id: int) -> DataFrame:
    """Room dimension of one supplier: capacity, contract header, hotel. Headers meet hotels first, so rooms of
    other suppliers are never shuffled twice."""
    hotels = tables.table("hotel_supplier").filter(F.col("supplier_id") == supplier_id)
    contracts = sold_contracts(tables, hotels)
    return tables.table("cnha").drop("hotel_id").join(contracts, "file_id").select(
        *ROOM, "country_code", "city_code", "hotel_code", "contract_name", "contract_number", "company_code",
        "currency", "minimum_child_age", "maximum_child_age", *CAPACITY,
    )


# slots that are no bin of the calendar: one for each bucket of rates, with the rules that are few enough and a room's own board
PLAIN, RATES = -(1 << 59), 8
CROWDED, BUCKETS = 512, 4096


def crowded_buckets(cnsr: DataFrame, most: int = CROWDED) -> list[int]:
    """Hash buckets of the (contract, bucket of rates) pairs with more than ``most`` board rules: at most ``BUCKETS`` numbers at any size. Both
    sides of the join look their bucket up, so that they agree, and a pair that shares a crowded one's bucket is binned as well."""
    rates = cnsr.filter(F.col("rate").isNotNull()).select("file_id", _plain_slot(F.col("rate").cast("string")).alias("rate"))
    counts = rates.groupBy("file_id", "rate").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    return [r.bucket for r in counts.select(_bucket("file_id", "rate").alias("bucket")).distinct().collect()]


def _bucket(file_id: str, rates: str | Column) -> Column:
    return F.pmod(F.xxhash64(file_id, rates), F.lit(BUCKETS)).cast("int")


def _plain_slot(rate: Column) -> Column:
    return F.lit(PLAIN) - F.pmod(F.xxhash64(rate), F.lit(RATES)).cast("long")


def _in_bins(rate: str, crowded: list[int]) -> Column:
    return _bucket("file_id", _plain_slot(F.col(rate))).isin(crowded) if crowded else F.lit(False)


def _key_rate(rate: Column) -> Column:
    """In bins of the calendar the rate is in the key, in a bucket of rates it is compared afterwards."""
    return F.when(F.col("slot") > PLAIN, rate).otherwise(F.lit(""))


def board_choices(rooms: DataFrame, cnsr: DataFrame, crowded: list[int]) -> DataFrame:
    """Every room with its base board (no rule) once in each bucket of rates, and once per board rule it may take and slot of the rule.

    Wildcards are resolved here, on the room dimension, so the price facts are joined once and on exact keys. A rule
    without a rate matches no price row of the cache and is left out, as is one of no day.
    """
    lo, hi = F.col("initial_date"), F.col("final_date")
    supplements = cnsr.filter(F.col("board_code").isNotNull() & F.col("rate").isNotNull() & (lo < hi)).select(
        *ROOM, "rule_id", F.col("board_code").alias("rule_board"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("cnsr_amount"),
        F.coalesce(F.col("percentage").cast("double"), F.lit(0.0)).alias("cnsr_percentage"),
        F.col("is_per_pax").alias("cnsr_is_per_pax"), F.col("rate").cast("string").alias("rule_rate"),
        lo.alias("rule_lo"), hi.alias("rule_hi"),
        iv.closed_int_range(F.col("min_age"), F.col("max_age")).alias("cnsr_pax_ages"),
    )
    base = rooms.withColumns({
        "cnsr_amount": F.lit(0.0), "cnsr_percentage": F.lit(0.0), "cnsr_is_per_pax": F.lit(""),
        "cnsr_pax_ages": iv.empty_int_range(), "slot": F.explode(F.sequence(F.lit(PLAIN - RATES + 1), F.lit(PLAIN))),
    })
    plain = F.array(_plain_slot(F.col("rule_rate")))
    slots = F.when(_in_bins("rule_rate", crowded), bins.right_slots(F.col("rule_lo"), F.col("rule_hi"))).otherwise(plain) if crowded else plain
    taken = match_rules(rooms, supplements).drop("rule_id").withColumn("slot", F.explode(slots))
    met = base.unionByName(taken, allowMissingColumns=True)
    return met.withColumn("key_rate", _key_rate(F.col("rule_rate"))) if crowded else met


def boarded_prices(prices: DataFrame, choices: DataFrame, crowded: list[int]) -> DataFrame:
    """Price rows next to the boards they can be served with, before rates and dates of a pair are compared.

    A price row meets its own board and the rules in the bucket of its rate, so that it is sent once. Where a contract has very many rules of a
    bucket, they are met by rate and bins of dates: a room with many dated prices and many rules doesn't build their product.
    """
    return sent_prices(prices, crowded).join(choices, [*ROOM, "slot", "key_rate"] if crowded else [*ROOM, "slot"])


def sent_prices(prices: DataFrame, crowded: list[int]) -> DataFrame:
    """Price rows by slot: one row each, and more only where a contract has very many rules."""
    rated = prices.withColumn("price_rate", pr.rule_rate(F.col("generic_rate"), F.col("specific_rate")))
    plain = _plain_slot(F.col("price_rate"))
    if not crowded:
        return rated.withColumn("slot", plain).drop("price_rate")
    dated = bins.left_slots(F.col("initial_date"), F.col("final_date"))
    binned = F.when(F.col("price_rate").isNotNull() & _in_bins("price_rate", crowded), F.concat(F.array(plain), dated)).otherwise(F.array(plain))
    return rated.withColumn("slot", F.explode(binned)).withColumn("key_rate", _key_rate(F.col("price_rate"))).drop("price_rate")


def takes_board() -> Column:
    """The own board, or a rule of the rate that shares a night with the price row: each pair passes in one slot only."""
    a, b, c, d = map(F.col, ("initial_date", "final_date", "rule_lo", "rule_hi"))
    rate = F.col("rule_rate") == pr.rule_rate(F.col("generic_rate"), F.col("specific_rate"))
    plain, own = F.col("slot") <= PLAIN, F.col("rule_lo").isNull()
    return (plain & (own | (rate & iv.intersects(a, b, c, d)))) | (~plain & bins.overlapping(F.col("slot"), a, b, c, d))


def build_cache(tables, supplier_id: int = 5, crowded_over: int = CROWDED, by_city: bool = False) -> DataFrame:
    """Base boards and supplementary boards in one pass over the price facts; ``by_city`` deals them by city for ``write_cache``, before the
    columns of the cache make them wide.

    The union is on the side of the rooms, so the facts are read once; dates of crowded contracts meet in bins (``interval_join``).
    """
    crowded = crowded_buckets(tables.table("cnsr"), crowded_over)
    choices = board_choices(rooms_of_supplier(tables, supplier_id), tables.table("cnsr"), crowded)
    prices = tables.table("cnct").select(
        *ROOM, "id", "initial_date", "final_date", "generic_rate", "specific_rate", "base_board", "amount",
        "is_price_per_pax",
    )
    board = F.coalesce(F.col("rule_board"), F.col("base_board"))
    rows = boarded_prices(prices, choices, crowded).filter(takes_board()).drop("slot", "key_rate", "rule_rate", "rule_lo", "rule_hi", "id")
    return (
        (rows.hint("rebalance", "country_code", "city_code") if by_city else rows)
        .select(
            "file_id",
            md5_key(F.col("contract_name"), F.col("contract_number").cast("string"), F.col("room_type"),
                    F.col("characteristic"), board).alias("rt_id"),
            "country_code", "city_code", "hotel_code", "contract_name", "contract_number",
            F.concat("room_type", F.lit("."), "characteristic").alias("room_type_id"),
            F.concat("base_board", F.lit("-"), "company_code").alias("meal_type"),
            "room_type", "characteristic",
            F.coalesce("generic_rate", "specific_rate").alias("rate"),
            board.alias("board"), "cnsr_amount", "cnsr_percentage", "cnsr_is_per_pax",
            F.col("initial_date").alias("lo"), F.col("final_date").alias("hi"),
            F.col("currency").alias("currency_code"),
            F.lit(0).alias("adult_price"), F.lit(0).alias("child_price"),
            F.col("amount").cast("double").alias("amount"), "is_price_per_pax",
            F.lit(0).alias("min_nights"),
            iv.closed_int_range(F.col("minimum_child_age"), F.col("maximum_child_age")).alias("childe_ages"),
            *CAPACITY, "cnsr_pax_ages",
        )
    )


def build_nightly_cache(tables, supplier_id: int = 5) -> DataFrame:
    """The first cache: single nights, with the minimum stay of the stay rules that name the room, and no capacity."""
    hotels = tables.table("hotel_supplier").filter(F.col("supplier_id") == supplier_id)
    contracts = sold_contracts(tables, hotels)
    rooms = tables.table("cnha").select(*ROOM).join(contracts, "file_id")
    resolved = rooms.join(tables.table("cnem").select(*ROOM, "minimum_days"), ROOM)
    night = F.col("night")
    minimum = F.coalesce("minimum_days", F.lit(0))
    return by_night(tables.table("cnct")).join(resolved, ROOM).select(
        "file_id", md5_key(*ROOM).alias("rt_id"), "country_code", "city_code",
        F.col("hotel_code").cast("int").alias("hotel_code"),
        F.concat("room_type", F.lit("."), "characteristic").alias("room_type"),
        F.concat("base_board", F.lit("-"), "company_code").alias("meal_type"),
        night.alias("lo"), F.date_add(night, 1).alias("hi"),
        F.col("currency").alias("currency_code"), F.lit(0).alias("adult_price"), F.lit(0).alias("child_price"),
        F.col("amount").cast("double").alias("amount"), "is_price_per_pax",
        F.when(minimum == 0, F.lit(0)).otherwise(minimum - 1).alias("min_nights"),
        F.col("minimum_child_age").alias("child_from"), F.col("maximum_child_age").alias("child_to"),
    )


CACHE_OFFER = [
    "file_id", "rt_id", "country_code", "city_code", "hotel_code", "contract_name", "contract_number", "room_type",
    "characteristic", "rate", "board", "meal_type", "currency_code", "is_price_per_pax", "min_nights", "childe_ages",
    *CAPACITY,
]
BOARD_TERM = ["cnsr_amount", "cnsr_percentage", "cnsr_is_per_pax", "cnsr_pax_ages"]


def party_of(ages: Column) -> dict[str, Column]:
    """Paying guests, adults and children of the party by the child ages of the contract: infants are younger than
    they begin, adults older than they end. Without child ages every guest is an adult."""
    lo, hi = F.col("childe_ages")["lo"], F.col("childe_ages")["hi"]
    number = lambda test: F.size(F.filter(ages, lambda a: F.coalesce(test(a), F.lit(False))))
    paxes = F.size(ages) - number(lambda a: a < lo)
    childes = number(lambda a: (a >= lo) & (a < hi))
    return {"paxes": paxes, "adults": paxes - childes, "childes": childes}


def occupancy() -> Column:
    """The classified party against the occupancy bounds of a room; infants need no place."""
    return (
        (F.col("paxes") > 0) & F.col("paxes").between(F.col("min_pax"), F.col("max_pax"))
        & F.col("adults").between(F.col("min_adult"), F.col("max_adult")) & (F.col("childes") <= F.col("max_children"))
    )


def cached_offers(cache: DataFrame, stay: Stay) -> DataFrame:
    """Offers of the cache with a price for every night of the stay, one row per offer and board term.

    Nights times amount are summed, so a stay that spans two prices is kept; coverage is by distinct nights, so a night with two
    prices doesn't stand in for one without.
    """
    lo, hi = F.col("lo"), F.col("hi")
    found = (
        cache.filter((lo < stay.hi) & (hi > stay.lo) & (lo < hi))
        .filter(F.col("min_nights") <= stay.nights)
        .withColumns(party_of(stay.ages_col))
        .filter(occupancy())
    )
    if stay.city_prefix:
        found = found.filter(F.col("city_code").startswith(stay.city_prefix))
    found = found.withColumn("nights", iv.common_nights(lo, hi, stay.lo, stay.hi))
    return fully_covered(found, [*CACHE_OFFER, *BOARD_TERM, "paxes"], night_words(stay, "lo", "hi"))


def cached_rooms(cache: DataFrame, stay: Stay) -> DataFrame:
    """Offers of the cache in the shape of ``availability.offers``, for the rule list: own boards only, as supplementary
    boards come with the rules, every night priced, one offer per rate."""
    own = cache.filter(iv.is_empty(F.col("cnsr_pax_ages")) & (F.col("cnsr_is_per_pax") == ""))
    if stay.city_prefix:
        own = own.filter(F.col("city_code").startswith(stay.city_prefix))
    prices = own.filter(F.col("min_nights") <= stay.nights).withColumnsRenamed(
        {"lo": "initial_date", "hi": "final_date", "board": "base_board", "currency_code": "currency"})
    room = (
        *ROOM_KEY, "rate", "hotel_code", "contract_number", "contract_name", "currency", "country_code", "city_code", "childe_ages",
        *CAPACITY,
    )
    bounds = {
        "minimum_child_age": F.col("childe_ages")["lo"], "maximum_child_age": F.col("childe_ages")["hi"] - 1,
    }
    return (
        with_party(sold_rooms(prices, stay, room).withColumns(bounds), stay.ages_col)
        .filter(fits(F.col("paxes"), F.col("childes")))
        .withColumns({
            "cnct_id": md5_key("file_id", "room_type", "characteristic", "base_board", F.coalesce("rate", F.lit(""))),
            "stay_amount": F.col("stay_amount").cast("double"),
            "amount": F.col("stay_amount").cast("double") / F.col("sum_nights"),
        })
        .drop("childe_ages", "minimum_child_age", "maximum_child_age")
    )


def priced_offers(cache: DataFrame, stay: Stay) -> DataFrame:
    """Room and board price per offer for one night, and the price of the stay.

    A board term counts when it has no age limit or some guest is inside it; the terms of an offer are added up.
    Prices per guest are for the paying guests. Rates are different offers.
    """
    guests = F.col("paxes")
    allowed = iv.is_empty(F.col("cnsr_pax_ages")) | F.exists(
        stay.ages_col, lambda age: iv.in_range(age, F.col("cnsr_pax_ages"))
    )
    nightly = F.col("stay_amount").cast("double") / F.col("sum_nights")
    room = px.room_total(nightly, F.col("is_price_per_pax"), guests)
    term = px.board_term(
        room, F.col("is_price_per_pax"), F.col("standard_capacity"), guests,
        F.col("cnsr_amount"), F.col("cnsr_percentage"), F.col("cnsr_is_per_pax"),
    )
    return (
        cached_offers(cache, stay)
        .filter(allowed)
        .groupBy(*CACHE_OFFER, "paxes", "sum_nights", "stay_amount")
        .agg(F.max(room).alias("room_price"), F.sum(term).alias("board_price"), F.count(F.lit(1)).alias("terms"))
        .withColumn("price", (F.col("room_price") + F.col("board_price")) * stay.nights)
    )
