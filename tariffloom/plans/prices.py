"""Price terms of rooms and boards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv
from tariffloom.functions import predicates as pr
from tariffloom.functions import pricing as px
from tariffloom.functions.keys import money
from tariffloom.operators import availability as av
from tariffloom.operators import rules, terms
from tariffloom.operators.cache import build_cache, priced_offers
from tariffloom.operators.rule_list import priced_boards
from tariffloom.plans.common import ANY_CITY, COUPLE, FAMILY, query

PRICE_TERMS = ("service_base_price", "pax_base_price", "service_base_board_price", "pax_base_board_price")
OFFER = ["cnct_id", "file_id", "room_type", "characteristic", "base_board", "is_price_per_pax"]


def _boards(t, how: str = "inner") -> DataFrame:
    return rules.board_rules(av.offers(t, FAMILY), t.table("cnsr"), FAMILY, how=how)


@query
def base_price_terms(t) -> DataFrame:
    """Four base terms per offer and board rule."""
    return priced_boards(_boards(t, "left")).select(
        "cnct_id", F.coalesce("rule_id", F.lit(-1)).alias("rule_id"), *[money(F.col(c)).alias(c) for c in PRICE_TERMS]
    )


# the party of the board ladder: ages and the date its rules must be valid on come from the stay
@query
def board_price_ladder(t) -> DataFrame:
    """Board price per guest of rooms priced through the whole stay, by rules naming the room."""
    n = len(COUPLE.ages)
    prices = t.table("cnct").filter(
        iv.covers_strictly(F.col("initial_date"), F.col("final_date"), COUPLE.lo, COUPLE.hi)
    )
    capacity = t.table("cnha").filter(F.col("max_pax") > n).select(*av.ROOM, "standard_capacity")
    guests = prices.join(capacity, av.ROOM).select(
        "id", *av.ROOM, "is_price_per_pax", F.col("amount").alias("room_amount"), "standard_capacity",
        F.posexplode(COUPLE.ages_col).alias("pax", "pax_age"),
    )
    boards = t.table("cnsr").filter(
        iv.valid_on(F.col("initial_date"), F.col("final_date"), COUPLE.lo)
    ).select(*av.ROOM, "rule_id", "is_per_pax", "amount", "percentage", "min_age", "max_age")
    age_ok = pr.in_band(F.col("pax_age"), F.col("min_age"), F.col("max_age"))
    g, b = guests.alias("g"), boards.alias("b")
    joined = g.join(
        b,
        (F.col("g.file_id") == F.col("b.file_id")) & (F.col("g.room_type") == F.col("b.room_type"))
        & (F.col("g.characteristic") == F.col("b.characteristic")) & age_ok,
        "left",
    )
    room, capacity_, pct = F.col("room_amount"), F.col("standard_capacity"), F.col("percentage")
    by_guest, room_by_guest = F.col("is_per_pax") == "Y", F.col("is_price_per_pax") == "Y"
    price = (
        F.when(px.present(F.col("amount")), F.col("amount"))
        .when(room_by_guest & by_guest, room * pct / 100)
        .when(~room_by_guest & ~by_guest, room * pct / 100)
        .when(~room_by_guest & by_guest, room / capacity_ * pct / 100)
        .when(room_by_guest & ~by_guest, room * capacity_ * pct / 100)
        .otherwise(F.lit(0.0))
    )
    return joined.select(
        "id", "pax_age", F.coalesce("rule_id", F.lit(-1)).alias("rule_id"), money(price).alias("bb_price")
    )


@query
def base_plus_board(t) -> DataFrame:
    """Room price plus all board prices per offer, with the counts that prove completeness."""
    sbp, pbp, sbbp, pbbp = PRICE_TERMS
    rows = priced_boards(_boards(t))
    return rows.groupBy("cnct_id").agg(
        money(F.max(sbp) + F.max(pbp) + F.sum(sbbp) + F.sum(pbbp)).alias("base_price"),
        F.count(sbp).alias("c_sbp"), F.count(pbp).alias("c_pbp"),
        F.count(sbbp).alias("c_sbbp"), F.count(pbbp).alias("c_pbbp"), F.count(F.lit(1)).alias("c_all"),
    )


def _board_terms(t, key: list[str]) -> DataFrame:
    rows = _boards(t).select(
        *key, F.col("cnsr_amount").alias("amount"), F.col("cnsr_percentage").alias("pct"),
        F.col("cnsr_is_per_pax").alias("flag"),
    )
    return rows


@query
def board_terms_array(t) -> DataFrame:
    """Board terms per offer as one JSON array."""
    listed = terms.listed_terms(_board_terms(t, ["cnct_id"]), ["cnct_id"], ["amount", "pct", "flag"])
    return listed.select("cnct_id", terms.as_json(F.col("terms")).alias("cnsr_board"))


@query
def json_terms_read(t) -> DataFrame:
    """Board terms read back from their JSON text: how many, the first one's flag, their fixed amounts added up."""
    listed = terms.listed_terms(_board_terms(t, ["cnct_id"]), ["cnct_id"], ["amount", "pct", "flag"])
    text = listed.select("cnct_id", terms.as_json(F.col("terms")).alias("text"))
    read = text.withColumn("terms", terms.from_json_text(F.col("text"), "amount: double, pct: double, flag: string"))
    total = F.aggregate("terms", F.lit(0.0), lambda acc, x: acc + F.coalesce(x["amount"], F.lit(0.0)))
    return read.select(
        "cnct_id", F.size("terms").alias("n_terms"), F.get("terms", F.lit(0))["flag"].alias("first_flag"), money(total).alias("amount"))


@query
def json_rollup(t) -> DataFrame:
    """Pair rules of a contract as one JSON array of rows."""
    listed = terms.listed_terms(t.table("cnoe"), ["file_id"], ["code1", "code2", "is_included"])
    return listed.select("file_id", terms.as_json(F.col("terms")).alias("cnoe"))


@query
def json_group_key(t) -> DataFrame:
    """Offers grouped by the JSON of their discount terms."""
    matched = rules.discount_rules(av.offers(t, FAMILY), t.table("cnsu"), FAMILY, how="inner")
    rows = matched.select(
        "cnct_id", "type", "application_type", F.col("sad_amount").alias("amount"),
        F.col("sad_percentage").alias("percentage"),
    )
    listed = terms.listed_terms(rows, ["cnct_id"], ["type", "application_type", "amount", "percentage"])
    return listed.groupBy(terms.as_json(F.col("terms")).alias("cnsu_sad")).agg(F.count(F.lit(1)).alias("offers"))


@query
def board_grouping_sets(t) -> DataFrame:
    """Room row and board rows of every offer from two grouping sets."""
    grouped = terms.board_grouping_sets(_boards(t, "left"))
    text = [F.coalesce(c, F.lit("")).alias(c) for c in
            ("room_type", "characteristic", "base_board", "board_code", "cnsr_is_per_pax", "board")]
    return grouped.select(
        "cnct_id", "file_id", *text, F.coalesce("cnsr_amount", F.lit(0.0)).alias("cnsr_amount"),
        F.coalesce("cnsr_percentage", F.lit(0.0)).alias("cnsr_percentage"), "rules", "is_board_row",
    )


@query
def room_board_price(t) -> DataFrame:
    """Room and board price of the cached offers; every board term brings its own flag."""
    prices = priced_offers(build_cache(t), ANY_CITY)
    return prices.select(
        "file_id", "rt_id", "room_type", "characteristic", F.coalesce("rate", F.lit("")).alias("rate"), "board", "sum_nights",
        "stay_amount", "terms",
        money(F.col("room_price")).alias("room_price"), money(F.col("board_price")).alias("board_price"),
    )


@query
def room_board_price_flag(t) -> DataFrame:
    """Room and board price where one flag holds for all terms of an offer."""
    key = ["cnct_id", "amount_", "is_price_per_pax", "standard_capacity", "paxes", "flag"]
    rows = _boards(t).select(
        "cnct_id", F.col("amount").alias("amount_"), "is_price_per_pax", "standard_capacity", "paxes",
        F.col("cnsr_is_per_pax").alias("flag"), F.col("cnsr_amount").alias("amount"),
        F.col("cnsr_percentage").alias("pct"),
    )
    room_flag, paxes = F.col("is_price_per_pax"), F.col("paxes")
    room = px.room_total(F.col("amount_"), room_flag, paxes)
    term = px.board_term(
        room, room_flag, F.col("standard_capacity"), paxes, F.col("amount"), F.col("pct"), F.col("flag"))
    priced = rows.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("n_terms"), F.sum(term).alias("board"))
    return priced.select(
        "cnct_id", "flag", "n_terms", money(room).alias("room_price"), money(F.col("board")).alias("board_price"))


QUERIES = {
    "base_price_terms": base_price_terms,
    "board_price_ladder": board_price_ladder,
    "base_plus_board": base_plus_board,
    "board_terms_array": board_terms_array,
    "json_terms_read": json_terms_read,
    "json_rollup": json_rollup,
    "json_group_key": json_group_key,
    "board_grouping_sets": board_grouping_sets,
    "room_board_price": room_board_price,
    "room_board_price_flag": room_board_price_flag,
}
