"""The supplements-and-discounts list: every offer with its base rows, rules and free nights, in one shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import pricing as px
from tariffloom.operators import rules
from tariffloom.operators.availability import offers as find_offers
from tariffloom.params import Stay
from tariffloom.sources.sinks import delete_matching, stored

OFFER_COLUMNS = [
    "cnct_id", "file_id", "hotel_code", "room_type", "characteristic", "base_board", "rest_nights", "paxes", "adults",
    "childes", "infants", "standard_capacity", "max_pax", "max_children", "cnct_is_per_pax",
]
BASE_TERMS = ("service_base_price", "pax_base_price", "service_base_board_price", "pax_base_board_price")


def priced_boards(matched: DataFrame) -> DataFrame:
    """Four base terms per offer and board rule: service and guest price of room and board."""
    room, flag = F.col("amount"), F.col("is_price_per_pax")
    capacity, paxes = F.col("standard_capacity"), F.col("paxes")
    amount, pct, by = F.col("cnsr_amount"), F.col("cnsr_percentage"), F.col("cnsr_is_per_pax")
    return matched.withColumns({
        "service_base_price": px.service_base_price(room, flag),
        "pax_base_price": px.pax_base_price(room, flag, paxes),
        "service_base_board_price": px.service_board_price(room, flag, capacity, amount, pct, by),
        "pax_base_board_price": px.pax_board_price(room, flag, capacity, paxes, amount, pct, by, F.col("billed")),
    })


FAMILIES = ("cnsr", "cnsu", "cngr")


def matched_rules(offers: DataFrame, tables, stay: Stay) -> DataFrame:
    """The three rule families of the offers in one shape, one row per offer and rule.

    ``pax_ids`` names the guests a rule meets.
    """
    boards = priced_boards(rules.board_rules(offers, tables.table("cnsr"), stay, how="inner")).selectExpr(
        "'cnsr' as sad_name", "cnct_id", "rule_id", "pax_ids", "week_days", "cnsr_is_per_pax", "board_code",
        *BASE_TERMS, f"{px.BASE_RANK} as order",
    )
    discounts = rules.discount_rules(offers, tables.table("cnsu"), stay, how="inner").selectExpr(
        "'cnsu' as sad_name", "cnct_id", "rule_id", "pax_ids", "times", "week_days", "sad_code", "order", "type",
        "application_type", "sad_amount as amount", "sad_percentage as percentage", "cnsu_is_per_pax",
        "cnsu_is_cumulative", "application_initial_date",
    )
    frees = rules.free_night_rules(offers, tables.table("cngr"), stay, how="inner").selectExpr(
        "'cngr' as sad_name", "cnct_id", "rule_id", "week_days", "sad_code", f"{px.FREE_NIGHT_RANK} as order", "frees",
        "discount", "application_base_type", "application_board_type", "application_discount_type",
        "application_stay_type",
    )
    return boards.unionByName(discounts, allowMissingColumns=True).unionByName(frees, allowMissingColumns=True)


def rule_list(offers: DataFrame, tables, stay: Stay) -> DataFrame:
    """Offers with their rules. A family without a rule keeps one row with an empty code, as a left join gives.

    Offers and matched rules are stored: the price facts are read once and each rule family is matched once, while
    the list itself, read several times by the steps after it, is only a join of the two.
    """
    found = stored(offers)
    matched = stored(matched_rules(found, tables, stay))
    head = found.selectExpr(
        *[c for c in OFFER_COLUMNS if c not in ("rest_nights", "cnct_is_per_pax")],
        f"{stay.nights} as rest_nights", "is_price_per_pax as cnct_is_per_pax", "amount as room_amount",
    )
    seen = matched.select("cnct_id", "sad_name").distinct()
    blanks = head.withColumn("sad_name", F.explode(F.array(*[F.lit(f) for f in FAMILIES]))).join(
        seen, ["cnct_id", "sad_name"], "left_anti"
    )
    rank = {"cnsr": px.BASE_RANK, "cngr": px.FREE_NIGHT_RANK}
    ranks = " ".join(f"when '{k}' then {v}" for k, v in rank.items())
    is_base = F.col("sad_name") == "cnsr"
    room, flag, paxes = F.col("room_amount"), F.col("cnct_is_per_pax"), F.col("paxes")
    blanks = blanks.withColumns({
        "order": F.expr(f"case sad_name {ranks} end"),
        "service_base_price": F.when(is_base, px.service_base_price(room, flag)),
        "pax_base_price": F.when(is_base, px.pax_base_price(room, flag, paxes)),
        "service_base_board_price": F.when(is_base, F.lit(0.0)),
        "pax_base_board_price": F.when(is_base, F.lit(0.0)),
    })
    return head.join(matched, "cnct_id").unionByName(blanks, allowMissingColumns=True).drop("room_amount")


def carry_board_flag(listed: DataFrame) -> DataFrame:
    """Give every row the board flag of its offer: per guest if any of its board rules is."""
    flags = listed.filter(F.col("sad_name") == "cnsr").groupBy("cnct_id").agg(
        F.max("cnsr_is_per_pax").alias("offer_board_flag")
    )
    return listed.join(flags, "cnct_id", "left").withColumn(
        "cnsr_is_per_pax", F.coalesce("cnsr_is_per_pax", "offer_board_flag")
    ).drop("offer_board_flag")


def incompatible(listed: DataFrame, cnoe: DataFrame) -> DataFrame:
    """(offer, code) pairs that a pair rule rules out.

    'Y': code2 goes when code1 is in the offer. 'N': code2 goes when code1 is not. One pass, not iterated.
    Codes are made distinct per offer first, so the joins never see the rows behind a code.
    """
    codes = listed.filter(F.col("sad_code").isNotNull()).select("cnct_id", "file_id", "sad_code").distinct()
    pairs = cnoe.select("file_id", "code1", F.col("code2").alias("sad_code"), "is_included").distinct()
    partners = codes.select("cnct_id", F.col("sad_code").alias("code1"), F.lit(True).alias("has_partner"))
    return (
        codes.join(pairs, ["file_id", "sad_code"])
        .join(partners, ["cnct_id", "code1"], "left")
        .filter(
            F.when(F.col("is_included") == "Y", F.col("has_partner"))
            .when(F.col("is_included") == "N", F.col("has_partner").isNull())
        )
        .select("cnct_id", "sad_code")
        .distinct()
    )


def drop_incompatible(listed: DataFrame, cnoe: DataFrame) -> DataFrame:
    return delete_matching(listed, incompatible(listed, cnoe), ["cnct_id", "sad_code"])


def searched_list(tables, stay: Stay, offers: DataFrame | None = None) -> DataFrame:
    """Offers (of the price rows, or those given), their rule list, pair rules applied."""
    found = find_offers(tables, stay) if offers is None else offers
    return drop_incompatible(rule_list(found, tables, stay), tables.table("cnoe"))
