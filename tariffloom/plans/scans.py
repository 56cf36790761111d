"""Scans, intervals and availability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom import schemas
from tariffloom.functions import intervals as iv
from tariffloom.functions.keys import md5_key, money, surrogate
from tariffloom.operators import availability as av
from tariffloom.operators.cache import occupancy
from tariffloom.plans.common import COUPLE, FAMILY, query, supplier_answers
from tariffloom.sources.load import COPY, load_rules
from tariffloom.sources.stored import RULE_TABLES, conform, key_violations, parse_text_dates


@query
def scan_contracts(t) -> DataFrame:
    """Typed scan of the dated room prices."""
    return conform(t.table("cnct"), "cnct").select(
        "file_id", "hotel_id", "id", "initial_date", "final_date", "room_type", "characteristic",
        F.coalesce("generic_rate", F.lit("")).alias("generic_rate"), "is_price_per_pax",
        F.coalesce("specific_rate", F.lit("")).alias("specific_rate"), "base_board", "amount",
    )


@query
def scan_api_answers(t) -> DataFrame:
    """Supplier answers: text files in, typed columns out."""
    typed, _ = supplier_answers(t)
    return typed.select(
        "req_id", "destination_code", "hotel_id", "contract_number", "contract_name", "check_in", "check_out", "adults",
        F.coalesce("children", F.lit("")).alias("children"), "room_type", "characteristic", "board", "amount", "min_pax",
    )


@query
def rejected_answers(t) -> DataFrame:
    """Lines of the supplier's files that are no answers, as they came."""
    return supplier_answers(t)[1].select("line")


@query
def key_violation_report(t) -> DataFrame:
    """Declared keys that are missing or repeated."""
    parts = []
    for name in ("ccon", "cnct", "cnha"):
        key = schemas.KEYS[name]
        found = key_violations(t.table(name), key)
        text = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
        parts.append(found.select(F.lit(name).alias("table_name"), text.alias("key"), "n"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def rule_load(t) -> DataFrame:
    """Rule tables as they are loaded: rules of a contract, their numbers, and how many of them are different."""
    held = load_rules(t, t.spark)
    parts = [held.loaded(name).select(F.lit(name).alias("table_name"), "file_id", "rule_id", COPY) for name in RULE_TABLES]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    first = F.col(COPY) == 1
    return rows.groupBy("table_name", "file_id").agg(
        F.count(F.lit(1)).alias("rules"), F.min("rule_id").alias("first_id"), F.max("rule_id").alias("last_id"),
        F.sum(first.cast("long")).alias("different"), F.max(COPY).alias("most_copies"),
    )


@query
def parse_dates(t) -> DataFrame:
    """Text dates of the board rules, some of them dirty."""
    rules = t.table("cnsr")
    text = rules.select(
        "rule_id",
        F.when(F.col("rule_id") % 11 == 0, F.lit("n/a"))
        .otherwise(F.date_format("initial_date", "yyyyMMdd")).alias("initial_date"),
        F.date_format("final_date", "yyyyMMdd").alias("final_date"),
    )
    return parse_text_dates(text, schemas.CNSR)


@query
def interval_column(t) -> DataFrame:
    """Single-night interval of every price row, and the interval of its validity."""
    night = F.date_add(F.col("initial_date"), F.col("days"))
    return t.table("cnct").select(
        "id", night.alias("lo"), F.date_add(night, 1).alias("hi"),
        F.datediff("final_date", "initial_date").alias("valid_nights"),
    )


@query
def overlap_filter(t) -> DataFrame:
    """SQL OVERLAPS of rule dates and stay: as given, with reversed ends, and as an instant."""
    a, b = F.col("initial_date"), F.col("final_date")
    s = FAMILY
    return t.table("cnsr").select(
        "rule_id", "file_id",
        iv.overlaps(a, b, s.lo, s.hi).cast("int").alias("as_given"),
        iv.overlaps(b, a, s.hi, s.lo).cast("int").alias("reversed_ends"),
        iv.overlaps(a, a, s.lo, s.hi).cast("int").alias("start_instant"),
        iv.overlaps(b, b, s.lo, s.hi).cast("int").alias("end_instant"),
    )


@query
def range_intersect_nights(t) -> DataFrame:
    """Nights shared by price interval and stay, and what they cost."""
    return av.touching(t.table("cnct"), FAMILY).select(
        "id", "nights", money(F.col("nights") * F.col("amount")).alias("price")
    )


@query
def stay_containment(t) -> DataFrame:
    """Rules valid for the whole stay, inclusive and strict."""
    a, b, s = F.col("initial_date"), F.col("final_date"), FAMILY
    return (
        t.table("cnsr")
        .filter(iv.covers(a, b, s.lo, s.hi))
        .select("rule_id", "file_id", iv.covers_strictly(a, b, s.lo, s.hi).cast("int").alias("strict"))
    )


@query
def rule_valid_on_date(t) -> DataFrame:
    """Rules valid at check-in."""
    return (
        t.table("cnsr")
        .filter(iv.valid_on(F.col("initial_date"), F.col("final_date"), FAMILY.lo))
        .select("rule_id", "file_id", "initial_date", "final_date")
    )


@query
def nightly_expand(t) -> DataFrame:
    """Price rows as single nights."""
    return av.nightly_rows(t.table("cnct")).select(
        "cnct_id", "file_id", "initial_date", "final_date", "room_type", "characteristic", "base_board", "amount"
    )


@query
def coverage_having(t) -> DataFrame:
    """Rooms with a price on every night of the stay."""
    return av.covered_rooms(t.table("cnct"), FAMILY)


@query
def distinct_on(t) -> DataFrame:
    """One price row per room: the earliest that touches the stay. A bounded minimum, no window over the room."""
    first = F.struct("initial_date", "id", "final_date", "amount")
    return (
        av.touching(t.table("cnct"), FAMILY)
        .groupBy(md5_key("file_id", "room_type", "characteristic", "base_board", sep="").alias("cnct_id"))
        .agg(F.min(first).alias("first"))
        .select("cnct_id", "first.initial_date", "first.final_date", "first.id", "first.amount")
    )


@query
def top_offers(t) -> DataFrame:
    """The hundred dearest rooms of the stay, ties by key."""
    rooms = av.available_rooms(t.table("cnct"), FAMILY)
    return rooms.orderBy(
        F.desc("stay_amount"), "file_id", "room_type", "characteristic", "base_board"
    ).limit(100)


@query
def city_prefix(t) -> DataFrame:
    """Hotels of one supplier in cities with a constant prefix."""
    return av.sold_by(t.table("hotel_supplier"), COUPLE)


@query
def stay_availability(t) -> DataFrame:
    """Rooms of a city that cover the stay and hold the party."""
    hotels = av.sold_by(t.table("hotel_supplier"), COUPLE)
    contracts = av.with_party(av.sold_contracts(t, hotels), COUPLE.ages_col)
    return (
        av.available_rooms(t.table("cnct"), COUPLE)
        .join(t.table("cnha").drop("hotel_id"), av.ROOM)
        .join(contracts, "file_id")
        .filter(occupancy())
        .select(
            "country_code", "city_code", "file_id", "contract_name", "room_type", "characteristic", "base_board",
            "is_price_per_pax", "standard_capacity", "sum_nights", "stay_amount",
        )
    )


@query
def surrogate_id(t) -> DataFrame:
    """A stable id per available room, without numbering rows."""
    return av.available_rooms(t.table("cnct"), FAMILY).select(
        surrogate("file_id", "room_type", "characteristic", "base_board").alias("id"),
        "file_id", "room_type", "characteristic", "base_board", "sum_nights",
    )


QUERIES = {
    "stay_availability": stay_availability,
    "scan_contracts": scan_contracts,
    "scan_api_answers": scan_api_answers,
    "rejected_answers": rejected_answers,
    "key_violations": key_violation_report,
    "rule_load": rule_load,
    "parse_dates": parse_dates,
    "interval_column": interval_column,
    "overlap_filter": overlap_filter,
    "range_intersect_nights": range_intersect_nights,
    "stay_containment": stay_containment,
    "rule_valid_on_date": rule_valid_on_date,
    "nightly_expand": nightly_expand,
    "coverage_having": coverage_having,
    "distinct_on": distinct_on,
    "top_offers": top_offers,
    "city_prefix": city_prefix,
    "surrogate_id": surrogate_id,
}
