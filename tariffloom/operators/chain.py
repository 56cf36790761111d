"""The reconciliation chain: offers against four rule families at once, without the product of the families.

Joining boards, discounts, free nights and stay rules to an offer one after the other builds a row for every combination of their rules, which
later groupings undo. What these groupings keep is one value per family, so each family is matched and summed up by
itself and the summaries are joined: an offer with b, d, f and s rules makes b + d + f + s rows instead of b * d * f * s.

Only two families make rows of the result: a board and flag that an offer can be served with, and the distinct bounds of the stay
rules that allow the stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import pricing as px
from tariffloom.operators import rules, terms
from tariffloom.params import Stay
from tariffloom.sources.sinks import stored

OFFER = [
    "cnct_id", "file_id", "contract_number", "contract_name", "room_type", "characteristic", "base_board", "is_price_per_pax", "amount",
    "standard_capacity", "paxes",
]


def board_summaries(offers: DataFrame, cnsr: DataFrame, stay: Stay) -> DataFrame:
    """Per offer, board code and flag: the terms as JSON, how many, and their price on top of the room."""
    matched = rules.board_rules(offers, cnsr, stay, how="inner")
    key = ["cnct_id", "board_code", "cnsr_is_per_pax"]
    room = px.room_total(F.col("amount"), F.col("is_price_per_pax"), F.col("paxes"))
    term = px.board_term(room, F.col("is_price_per_pax"), F.col("standard_capacity"), F.col("paxes"), F.col("cnsr_amount"), F.col("cnsr_percentage"),
                         F.col("cnsr_is_per_pax"))
    priced = matched.select(*key, F.col("cnsr_amount").alias("amount"), F.col("cnsr_percentage").alias("pct"), term.alias("term"))
    # equal terms are one row before they are gathered, with their number and price
    counted = priced.groupBy(*key, "amount", "pct").agg(F.count(F.lit(1)).cast("int").alias("copies"), F.sum("term").alias("price"))
    one = F.struct(F.struct("amount", "pct").alias("term"), F.col("copies"))
    gathered = counted.groupBy(*key).agg(
        F.array_sort(F.collect_list(one)).alias("counted"), F.sum("copies").cast("int").alias("n_terms"), F.sum("price").alias("board_price"))
    full = F.flatten(F.transform("counted", lambda x: F.array_repeat(x["term"], x["copies"])))
    return gathered.select(*key, "n_terms", "board_price", terms.as_json(full).alias("cnsr_sad"))


def discount_summaries(offers: DataFrame, cnsu: DataFrame, stay: Stay) -> DataFrame:
    """Per offer: its discount terms as JSON, each distinct one once, and how many rules stand behind them."""
    matched = rules.discount_rules(offers, cnsu, stay, how="inner")
    term = ["type", "application_type", F.col("sad_amount").alias("amount"), F.col("sad_percentage").alias("percentage")]
    counted = matched.select("cnct_id", *term).groupBy("cnct_id", "type", "application_type", "amount", "percentage").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("type", "application_type", "amount", "percentage")))
    return counted.groupBy("cnct_id").agg(terms.as_json(listed).alias("cnsu_sad"), F.sum("n").cast("int").alias("n_discounts"))


def free_night_counts(offers: DataFrame, cngr: DataFrame, stay: Stay) -> DataFrame:
    matched = rules.free_night_rules(offers, cngr, stay, how="inner")
    return matched.groupBy("cnct_id").agg(F.count(F.lit(1)).cast("int").alias("n_frees"))


def stay_bounds(offers: DataFrame, cnem: DataFrame, stay: Stay) -> DataFrame:
    """Per offer: the distinct bounds of its stay rules that allow the stay, both NULL where it has no rule; offers whose rules all forbid
    the stay have none."""
    return rules.stay_length_rules(offers, cnem, stay).select("cnct_id", "minimum_days", "maximum_days").distinct()


def priced_chain(offers: DataFrame, tables, stay: Stay) -> DataFrame:
    """Offers of the chain: per board and flag, and stay bounds, the summaries of all families and the price of the stay. The own board has no
    flag and no term."""
    found = stored(offers.select(*OFFER, *[c for c in offers.columns if c not in OFFER]))
    boards = board_summaries(found, tables.table("cnsr"), stay)
    head = found.select(*OFFER).withColumn("room_price", px.room_total(F.col("amount"), F.col("is_price_per_pax"), F.col("paxes")))
    own = head.withColumns({"board": F.col("base_board"), "n_terms": F.lit(0), "board_price": F.lit(0.0)})
    served = own.unionByName(head.join(boards.withColumnRenamed("board_code", "board"), "cnct_id"), allowMissingColumns=True)
    allowed = served.join(stay_bounds(found, tables.table("cnem"), stay), "cnct_id")
    with_rules = allowed.join(discount_summaries(found, tables.table("cnsu"), stay), "cnct_id", "left").join(
        free_night_counts(found, tables.table("cngr"), stay), "cnct_id", "left")
    priced = with_rules.withColumns({
        "n_discounts": F.coalesce("n_discounts", F.lit(0)), "n_frees": F.coalesce("n_frees", F.lit(0)),
        "price": (F.col("room_price") + F.col("board_price")) * stay.nights,
    })
    return stored(priced)
