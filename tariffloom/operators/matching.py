"""Rules against offers: contract, wildcards, and whatever else the rule asks for.

A wildcarded comparison is an OR and would leave the contract as the only join key, so every rule of a contract
would meet every room of it. Here a rule keeps one key (its value or the wildcard mark) and an offer carries
the keys it can be reached by, each once, so the whole wildcard test is an equi-join and only true matches are built.

Contracts with very many rules are split further: every key with more than ``per_bucket`` rules has its rules
spread over buckets, and its offers visit each bucket. The list of such keys has at most one row for ``per_bucket``
rules; how it is joined is left to adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions.predicates import WILD, rule_key
from tariffloom.sources.sinks import stored

KEYS = ["file_id", "room_key", "char_key"]


def crowded_keys(df: DataFrame, keys: list[str], per_bucket: int) -> DataFrame:
    """All keys with more than ``per_bucket`` rows, and the buckets they need."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_bucket)
    return counts.selectExpr(*keys, f"cast(ceil(n / {per_bucket}) as int) as buckets")


def keyed_rules(rules: DataFrame) -> DataFrame:
    return rules.withColumns(
        {"room_key": rule_key(F.col("room_type")), "char_key": rule_key(F.col("characteristic"))}
    ).drop("room_type", "characteristic")


def keyed_offers(offers: DataFrame) -> DataFrame:
    """The keys of an offer, as the product of two short generators. A blank value is the wildcard mark itself and
    gives one key only."""
    return offers.selectExpr("*", f"explode(array_distinct(array(room_type, '{WILD}'))) as room_key").selectExpr(
        "*", f"explode(array_distinct(array(characteristic, '{WILD}'))) as char_key"
    )


def match_rules(
    offers: DataFrame, rules: DataFrame, condition: Column | None = None, per_bucket: int = 4096
) -> DataFrame:
    """Inner match on contract and room wildcards. ``offers`` has file_id, room_type and characteristic.

    ``rules`` brings the same three plus ``rule_id``; its other columns must not clash with those of the offers.
    Filter the rules by date, booking window and stay length first: these tests need no offer.
    """
    right = keyed_rules(rules)
    crowded = crowded_keys(right, KEYS, per_bucket)
    right = right.join(crowded, KEYS, "left").selectExpr(
        *right.columns, "cast(pmod(xxhash64(rule_id), coalesce(buckets, 1)) as int) as bucket"
    )
    left = keyed_offers(offers)
    left = left.join(crowded, KEYS, "left").selectExpr(
        *left.columns, "explode(sequence(0, coalesce(buckets, 1) - 1)) as bucket"
    )
    matched = left.join(right, [*KEYS, "bucket"])
    if condition is not None:
        matched = matched.filter(condition)
    return matched.drop("room_key", "char_key", "bucket")


def keep_unmatched(offers: DataFrame, matched: DataFrame, key: str = "cnct_id") -> DataFrame:
    """Left-join semantics: offers without a rule stay, with the rule columns empty. The matches are stored, as they are
    read twice."""
    matched = stored(matched)
    lonely = offers.join(matched.select(key).distinct(), key, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)
