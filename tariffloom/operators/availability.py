"""Which rooms can be sold for the whole stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv
from tariffloom.functions import party
from tariffloom.functions.keys import md5_key
from tariffloom.params import Stay
from tariffloom.schemas import MONEY

ROOM_KEY = ("file_id", "room_type", "characteristic", "base_board", "is_price_per_pax")
ROOM = ["file_id", "room_type", "characteristic"]


def touching(prices: DataFrame, stay: Stay) -> DataFrame:
    """Price rows that share a night with the stay; the plain comparisons are pushed into the scan. Rows of no night,
    or with reversed dates, share none."""
    lo, hi = F.col("initial_date"), F.col("final_date")
    return prices.filter((lo < stay.hi) & (hi > stay.lo) & (lo < hi)).withColumn(
        "nights", iv.common_nights(lo, hi, stay.lo, stay.hi)
    )


def available_rooms(prices: DataFrame, stay: Stay, key: tuple[str, ...] = ROOM_KEY) -> DataFrame:
    """Coverage by summed nights. One aggregation on the full room key, combined before its shuffle, and done
    before any join: what follows works on rooms, not on price rows. Money is summed as decimal, so the sum does
    not depend on how the rows were partitioned."""
    return (
        touching(prices, stay)
        .groupBy(*key)
        .agg(
            F.sum("nights").cast("bigint").alias("sum_nights"),
            F.sum(F.col("nights") * F.col("amount").cast(MONEY)).alias("stay_amount"),
        )
        .filter(F.col("sum_nights") >= stay.nights)
    )


def by_night(prices: DataFrame) -> DataFrame:
    """Price rows by ``night``: the one that ``days`` names inside the contract window, else every night of the row. A row
    of no night or with reversed dates has none."""
    first, nights = F.col("initial_date"), F.datediff("final_date", "initial_date")
    every = F.when(nights > 0, F.sequence(F.lit(0), nights - 1))
    named = F.when(F.col("days").isNotNull(), F.array(F.col("days"))).otherwise(every)
    return prices.withColumn("night_no", F.explode(named)).withColumn("night", F.date_add(first, F.col("night_no"))).drop("night_no")


def nightly_rows(prices: DataFrame) -> DataFrame:
    """Price rows to single nights."""
    night = F.col("night")
    return by_night(prices).select(
        md5_key("file_id", "room_type", "characteristic", "base_board", sep="").alias("cnct_id"),
        "file_id", "hotel_id",
        night.alias("initial_date"), F.date_add(night, 1).alias("final_date"),
        "room_type", "characteristic", "generic_rate", "is_price_per_pax", "specific_rate", "base_board", "amount",
    )


def nights_of(prices: DataFrame, stay: Stay) -> DataFrame:
    """One row per price row and night of the stay; rows are clipped to the stay before they are expanded."""
    first = F.greatest(F.col("initial_date"), stay.lo)
    last = F.date_sub(F.least(F.col("final_date"), stay.hi), 1)
    return touching(prices, stay).withColumn("night", F.explode(F.sequence(first, last)))


def covered_rooms(prices: DataFrame, stay: Stay, key: tuple[str, ...] = ROOM_KEY) -> DataFrame:
    """Coverage by distinct nights: exact when price intervals of a room overlap."""
    return (
        nights_of(prices, stay)
        .groupBy(*key)
        .agg(
            F.countDistinct("night").alias("covered_nights"),
            F.count(F.lit(1)).alias("priced_nights"),
            F.sum(F.col("amount").cast(MONEY)).alias("amount"),
        )
        .filter(F.col("covered_nights") == stay.nights)
    )


NIGHTS_A_WORD = 62


def night_words(stay: Stay, lo: str = "initial_date", hi: str = "final_date") -> list[tuple[Column, int]]:
    """The nights of the stay that a price row covers, as bits: one number for each 62 nights, with its full value."""
    first = F.greatest(F.datediff(F.col(lo), stay.lo), F.lit(0))
    last = F.least(F.datediff(F.col(hi), stay.lo), F.lit(stay.nights))
    out = []
    for base in range(0, stay.nights, NIGHTS_A_WORD):
        size = min(stay.nights - base, NIGHTS_A_WORD)
        a, b = F.greatest(first - base, F.lit(0)), F.least(last - base, F.lit(size))
        one = F.lit(1).cast("long")
        bits = F.when(b > a, F.call_function("shiftleft", one, b) - F.call_function("shiftleft", one, a)).otherwise(F.lit(0).cast("long"))
        out.append((bits, (1 << size) - 1))
    return out


def sold_rooms(prices: DataFrame, stay: Stay, key: tuple[str, ...] = ROOM_KEY) -> DataFrame:
    """Rooms with a price for every night of the stay: the sums of ``available_rooms`` under exact coverage.

    Covered nights are the union of bits, so the rows are neither expanded nor made distinct: one aggregation,
    combined before its shuffle.
    """
    return fully_covered(touching(prices, stay), key, night_words(stay))


def fully_covered(rows: DataFrame, key: tuple[str, ...] | list[str], words: list[tuple[Column, int]]) -> DataFrame:
    """Groups of ``rows`` (nights, amount) that cover every night, with their summed nights and amounts."""
    sums = rows.groupBy(*key).agg(
        F.sum("nights").cast("bigint").alias("sum_nights"),
        F.sum(F.col("nights") * F.col("amount").cast(MONEY)).alias("stay_amount"),
        *[F.bit_or(bits).alias(f"covered_{k}") for k, (bits, _) in enumerate(words)],
    )
    for k, (_, full) in enumerate(words):
        sums = sums.filter(F.col(f"covered_{k}") == F.lit(full).cast("long")).drop(f"covered_{k}")
    return sums


# A window of level k is SPAN * 16^k days long and has REACH * 16^k more at its end, so that a stay of up to REACH * 16^k nights lies in the
# window in which it begins. The last level holds every stay.
SPAN_BITS, REACH, LEVEL_BITS, LEVELS = 9, 64, 4, 8
CROWDED, BUCKETS = 16384, 4096
SHARED, SUM = "decimal(26,7)", "decimal(36,7)"  # a product with nights and a sum of two keep their scale


def _shifted(name: str, value: Column, bits: Column | int) -> Column:
    return F.call_function(name, value.cast("long"), F.lit(bits) if isinstance(bits, int) else bits)


def stay_window(check_in: Column, check_out: Column) -> Column:
    """Number of the window a stay lies in: its place in the calendar, times ``LEVELS``, and the level."""
    nights = F.datediff(check_out, check_in)
    level = F.coalesce(*[F.when(nights <= REACH << LEVEL_BITS * k, F.lit(k)) for k in range(LEVELS - 1)], F.lit(LEVELS - 1))
    return _shifted("shiftright", F.unix_date(check_in), level * LEVEL_BITS + SPAN_BITS) * LEVELS + level


def asked_windows(requests: DataFrame) -> list[int]:
    """Windows that stays lie in, at most a few thousand in a calendar of ten thousand years."""
    asked = requests.filter("check_in < check_out").select(stay_window(F.col("check_in"), F.col("check_out")).alias("w")).distinct()
    return sorted(r.w for r in asked.collect())


def _touched(lo: Column, hi: Column, windows: list[int]) -> Column:
    """Those of ``windows`` that share a day with [lo, hi), days as numbers."""
    out = [F.array().cast("array<long>")]
    for k in sorted({w % LEVELS for w in windows}):
        places, bits = [w // LEVELS for w in windows if w % LEVELS == k], SPAN_BITS + LEVEL_BITS * k
        first = F.greatest(_shifted("shiftright", lo.cast("long") - (REACH << LEVEL_BITS * k), bits), F.lit(places[0]))
        last = F.least(_shifted("shiftright", hi.cast("long") - 1, bits), F.lit(places[-1]))
        if places[-1] - places[0] + 1 == len(places):
            met = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<long>"))
        else:  # windows with gaps: a price row without an end is not expanded over them
            met = F.filter(F.array(*[F.lit(p).cast("long") for p in places]), lambda p: (p >= first) & (p <= last))  # noqa: B023
        out.append(F.transform(met, lambda p: p * LEVELS + k))  # noqa: B023
    return F.concat(*out)


def crowded_contracts(prices: DataFrame, most: int = CROWDED) -> list[int]:
    """Hash buckets of the contracts with more than ``most`` price rows, at most ``BUCKETS`` numbers at any size."""
    counts = prices.groupBy("file_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    return [r.bucket for r in counts.select(_bucket().alias("bucket")).distinct().collect()]


def _bucket() -> Column:
    return F.pmod(F.xxhash64("file_id"), F.lit(BUCKETS)).cast("int")


def room_windows(prices: DataFrame, windows: list[int], key: tuple[str, ...] = ROOM_KEY, crowded_over: int = CROWDED) -> DataFrame:
    """A row per room and window in which it has a price: ``_held``, its dates cut to the window, in order, with the number of price rows and
    their summed amount.

    Rows of crowded contracts with equal dates are summed up first, combined before their shuffle, so that a list is bounded by the dates of a
    window, or by ``crowded_over``, however many rows a room has.
    """
    lo, hi = F.col("_lo"), F.col("_hi")
    days = prices.filter("initial_date < final_date").select(
        *key, F.unix_date("initial_date").alias("_lo"), F.unix_date("final_date").alias("_hi"), F.col("amount").cast(MONEY).alias("_amount"))
    level, place = F.col("_window").bitwiseAND(LEVELS - 1).cast("int"), _shifted("shiftright", F.col("_window"), 3)
    start = _shifted("shiftleft", place, level * LEVEL_BITS + SPAN_BITS)
    end = start + _shifted("shiftleft", F.lit((1 << SPAN_BITS) + REACH), level * LEVEL_BITS)
    cut = days.withColumn("_window", F.explode(_touched(lo, hi, windows))).select(
        *key, "_window", F.greatest(lo, start).cast("int").alias("_lo"), F.least(hi, end).cast("int").alias("_hi"), "_amount")
    crowded = crowded_contracts(prices, crowded_over) if windows else []
    one = [F.lit(1).cast("long").alias("_n"), F.col("_amount").cast(SHARED).alias("_amount")]
    rows = cut.filter(~_bucket().isin(crowded)) if crowded else cut
    rows = rows.select(*key, "_window", "_lo", "_hi", *one)
    if crowded:
        rows = rows.unionByName(cut.filter(_bucket().isin(crowded)).groupBy(*key, "_window", "_lo", "_hi").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("_amount").cast(SHARED).alias("_amount")))
    return rows.groupBy(*key, "_window").agg(F.sort_array(F.collect_list(F.struct("_lo", "_hi", "_n", "_amount"))).alias("_held"))


def rooms_for_requests(prices: DataFrame, requests: DataFrame, key: tuple[str, ...] = ROOM_KEY, windows: list[int] | None = None,
                       rooms: DataFrame | None = None, crowded_over: int = CROWDED) -> DataFrame:
    """``sold_rooms`` for a whole table of stays in one plan: per request (file_id, check_in, check_out; other columns come along) the rooms of
    its contract with a price for every night, their summed nights and amounts, and the columns of ``rooms`` (by room) where it is given.

    Price rows are gathered once by room and window of the calendar, and a stay lies in one window of a room. So a request meets a room in
    one row, and what is found, many times the input, is not shuffled again.
    """
    wanted = requests.filter("check_in < check_out").withColumns({
        "stay_nights": F.datediff("check_out", "check_in"), "_in": F.unix_date("check_in"), "_out": F.unix_date("check_out"),
        "_window": stay_window(F.col("check_in"), F.col("check_out"))})
    held = room_windows(prices, asked_windows(requests) if windows is None else windows, key, crowded_over)
    if rooms is not None:
        held = held.join(rooms, ROOM)
    first, past = F.col("_in"), F.col("_out")
    shared = F.filter("_held", lambda e: (e["_lo"] < past) & (e["_hi"] > first))
    reached = lambda rows: F.aggregate(rows, first, lambda day, e: F.when(e["_lo"] <= day, F.greatest(day, e["_hi"])).otherwise(day))
    met = wanted.join(held, ["file_id", "_window"]).withColumn("_met", F.explode(F.filter(F.array(shared), lambda rows: reached(rows) >= past)))
    nights = lambda e: F.least(e["_hi"], past) - F.greatest(e["_lo"], first)
    amounts = F.transform("_met", lambda e: (nights(e).cast("decimal(9,0)") * e["_amount"]).cast(SUM))
    known = F.filter(amounts, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0).cast(SUM), lambda a, x: (a + x).cast(SUM))
    return met.withColumns({
        "sum_nights": F.aggregate("_met", F.lit(0).cast("long"), lambda a, e: a + nights(e) * e["_n"]),
        "stay_amount": F.when(F.size(known) > 0, total).cast("decimal(38,7)"),
    }).drop("_window", "_in", "_out", "_held", "_met")


def with_party(contracts: DataFrame, ages: Column) -> DataFrame:
    """Guests of the party per contract, classified by the contract's child-age bounds."""
    return (
        contracts.withColumn("ages", ages)
        .withColumns({
            "guests": party.classified(),
            "childes": F.size(party.ages_of_children()),
            "infants": F.size(party.ages_of_infants()),
        })
        .selectExpr("*", "size(ages) - infants as paxes", "size(ages) - infants - childes as adults")
        .drop("ages")
    )


def sold_by(hotels: DataFrame, stay: Stay) -> DataFrame:
    """Hotels of the supplier, and of the cities that start with the prefix."""
    out = hotels.filter(F.col("supplier_id") == stay.supplier_id)
    return out.filter(F.col("city_code").startswith(stay.city_prefix)) if stay.city_prefix else out


def fits(paxes: Column, childes: Column) -> Column:
    """Capacity of the room against the paying guests; a party of infants only is not an offer."""
    return (paxes > 0) & (F.col("max_pax") >= paxes) & (F.col("max_children") >= childes)


def sold_contracts(tables, hotels: DataFrame) -> DataFrame:
    """Contract headers of the hotels, reduced to what offers carry."""
    headers = tables.table("ccon").select(
        "file_id", "hotel_code", "contract_number", "contract_name", "company_code", "currency", "minimum_child_age",
        "maximum_child_age",
    )
    return headers.join(hotels, F.col("hotel_code") == F.col("supplier_hotel_code"))


def offers(tables, stay: Stay) -> DataFrame:
    """Rooms with a price for every night, with capacity, contract header, hotel and classified guests.

    ``amount`` is the price of one night, averaged over the stay.
    """
    rooms = sold_rooms(tables.table("cnct"), stay)
    hotels = sold_by(tables.table("hotel_supplier"), stay)
    contracts = with_party(sold_contracts(tables, hotels), stay.ages_col)
    return (
        rooms.join(tables.table("cnha").drop("hotel_id"), ROOM)
        .join(contracts, "file_id")
        .filter(fits(F.col("paxes"), F.col("childes")))
        .select(
            md5_key("file_id", "room_type", "characteristic", "base_board").alias("cnct_id"),
            *ROOM_KEY, "sum_nights", F.col("stay_amount").cast("double").alias("stay_amount"),
            (F.col("stay_amount").cast("double") / F.col("sum_nights")).alias("amount"),
            "hotel_code", "contract_number", "contract_name", "currency", "country_code", "city_code",
            "standard_capacity", "min_pax", "max_pax", "max_adult", "max_children", "max_infant", "min_adult",
            "guests", "paxes", "adults", "childes", "infants",
        )
    )
