"""Computed prices against the answers of the supplier."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the text keys both sides share
API_KEY = ["contract_number", "contract_name", "room_type", "characteristic", "board"]


def deduplicated(api: DataFrame) -> DataFrame:
    return api.distinct()


def api_side(api: DataFrame) -> DataFrame:
    return deduplicated(api.select(*API_KEY, F.col("amount").alias("api_amount")))


def keyed(offers: DataFrame) -> DataFrame:
    return offers.withColumn("contract_number", F.col("contract_number").cast("string"))


def nearest_answer(offers: DataFrame, api: DataFrame) -> DataFrame:
    """Answered offers, each once, with the nearest of the answers under its keys.

    The keys don't tell an offer from its other rates, so several answers may meet it. One that rounds to its price comes
    first, then the one least away, then the smaller.
    """
    ours = keyed(offers)
    away = F.struct(
        (F.bround("api_amount") != F.bround("price")).alias("differs"),
        F.round(F.abs(F.col("api_amount") - F.col("price")), 4).alias("away"), F.col("api_amount").alias("amount"),
    )
    # grouped by a number of the row, not by all its columns; prices are stored, so a task that runs again numbers them alike
    numbered = ours.withColumn("_row", F.monotonically_increasing_id())
    met = numbered.join(api_side(api).filter(F.col("api_amount").isNotNull()), API_KEY)
    nearest = met.groupBy("_row").agg(F.any_value(F.struct(*[f"`{c}`" for c in ours.columns])).alias("_offer"), F.min(away)["amount"].alias("api_amount"))
    return nearest.select("_offer.*", "api_amount")


def reconcile(offers: DataFrame, api: DataFrame) -> DataFrame:
    """Answered offers of which no answer has the rounded price; halves round to even on both sides."""
    ours, theirs = F.bround("price"), F.bround("api_amount")
    return nearest_answer(offers, api).filter(theirs != ours).withColumn("difference", theirs - ours)


def price_check(offers: DataFrame, api: DataFrame) -> DataFrame:
    """Offers next to their nearest answer, answered ones only."""
    return nearest_answer(offers, api)


def answers_for(api: DataFrame, check_in: dt.date, check_out: dt.date, children: str = "") -> DataFrame:
    """Answers about one stay of one party."""
    return api.filter((F.col("check_in") == F.lit(check_in)) & (F.col("check_out") == F.lit(check_out)) & (
        F.coalesce("children", F.lit("")) == children))


def missing_from_api(offers: DataFrame, api: DataFrame) -> DataFrame:
    return keyed(offers).join(api.select(*API_KEY).distinct(), API_KEY, "left_anti")


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
