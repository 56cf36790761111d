"""Checks of computed prices against supplier answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions.keys import money
from tariffloom.operators import availability as av
from tariffloom.operators import chain
from tariffloom.operators import reconcile as rec
from tariffloom.plans.common import COUPLE, FAMILY, query, searched_prices, supplier_answers

KEY = rec.API_KEY


def _answers(t, children: str = "") -> DataFrame:
    return rec.answers_for(supplier_answers(t)[0], COUPLE.check_in, COUPLE.check_out, children)


@query
def api_dedup(t) -> DataFrame:
    """Supplier answers without repeats."""
    return rec.deduplicated(_answers(t).select("req_id", "check_in", "check_out", *KEY, "amount"))


@query
def duplicate_offers(t) -> DataFrame:
    """Price rows that repeat another one but for their dates."""
    key = ["file_id", "hotel_id", "room_type", "characteristic", "is_price_per_pax", "specific_rate", "base_board",
           "amount"]
    found = rec.duplicates(t.table("cnct"), key)
    return found.withColumn("specific_rate", F.coalesce("specific_rate", F.lit("")))


@query
def reconcile_prices(t) -> DataFrame:
    """Offers priced differently from the supplier's answer."""
    prices = searched_prices(t)
    out = rec.reconcile(prices, _answers(t))
    return out.select(*KEY, money(F.col("price")).alias("price"), "api_amount", "difference")


@query
def price_check(t) -> DataFrame:
    """Offers next to the supplier's answer."""
    prices = searched_prices(t)
    out = rec.price_check(prices, _answers(t))
    return out.select(
        *KEY, "api_amount", money(F.col("room_price")).alias("room_price"),
        money(F.col("board_price")).alias("board_price"), money(F.col("price")).alias("price"),
    )


@query
def missing_from_api(t) -> DataFrame:
    """Offers the supplier did not answer."""
    prices = searched_prices(t)
    return rec.missing_from_api(prices, _answers(t)).select("file_id", *KEY)


@query
def reconcile_chain(t) -> DataFrame:
    """The whole chain: offers with all rule families, stay lengths, board terms as JSON, one price per board and flag, and what the
    supplier answered where it differs."""
    priced = chain.priced_chain(av.offers(t, FAMILY), t, FAMILY)
    out = rec.reconcile(priced, _answers(t, "5 1"))
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("cnsr_is_per_pax", "cnsr_sad", "cnsu_sad")]
    return out.select(
        "cnct_id", *KEY, *text, F.coalesce("minimum_days", F.lit(-1)).alias("minimum_days"), F.coalesce("maximum_days", F.lit(-1)).alias("maximum_days"),
        "n_terms", "n_discounts", "n_frees", money(F.col("room_price")).alias("room_price"), money(F.col("board_price")).alias("board_price"),
        money(F.col("price")).alias("price"), "api_amount", "difference",
    )


QUERIES = {
    "api_dedup": api_dedup,
    "duplicate_offers": duplicate_offers,
    "reconcile_prices": reconcile_prices,
    "price_check": price_check,
    "missing_from_api": missing_from_api,
    "reconcile_chain": reconcile_chain,
}
