"""Running prices and neighbour tests inside one offer, without holding an offer in one task.

A window over an offer would pull all its rules into one task. Here the rules of all offers are put in one order over range
partitions; windows hold one piece of an offer, and what earlier pieces leave is carried over the cuts (``operators.pieces``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import pricing as px
from tariffloom.operators import fold
from tariffloom.operators.pieces import neighbours, placed, prefix_scan
from tariffloom.sources.sinks import stored

PRICES = ("service_base_price", "service_base_board_price", "pax_base_price", "pax_base_board_price")


def _last(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _rows(listed: DataFrame, stay, base: DataFrame) -> DataFrame:
    """Base rows and rules to price in one shape: what a base row adds to the board prices, what step a rule takes."""
    rules = fold.steps(fold.rules_to_price(listed, stay), base).select(
        "cnct_id", F.lit("cnsu").alias("sad_name"), *fold.RULE_ORDER, _state(*fold.COEFFICIENTS))
    boards = listed.filter(F.col("sad_name") == "cnsr").select(
        "cnct_id", "sad_name", F.lit(px.BASE_RANK).alias("order"), "rule_id",
        _state(*[F.lit(fold.IDENTITY[n]).alias(n) for n in fold.COEFFICIENTS], sbb=F.col("service_base_board_price"), pbb=F.col("pax_base_board_price")))
    return boards.unionByName(rules, allowMissingColumns=True)


def _state(*step: Column | str, sbb: Column | None = None, pbb: Column | None = None) -> Column:
    none = F.lit(0.0)
    return F.struct(F.struct(*step).alias("step"), (none if sbb is None else sbb).alias("sbb"), (none if pbb is None else pbb).alias("pbb")).alias("state")


def _after(first: Column, second: Column) -> Column:
    return F.struct(fold.then(first["step"], second["step"]).alias("step"), (first["sbb"] + second["sbb"]).alias("sbb"), (
        first["pbb"] + second["pbb"]).alias("pbb"))


def running_price(listed: DataFrame, stay) -> DataFrame:
    """Four prices of an offer after each row of its list: after every base row, which add up the board prices, then after every
    rule with a night to act on, in rule order. The last row of an offer has the prices of ``fold.fold_prices``.

    A rule is an affine step (see ``fold``), so the price after it is a prefix of composed steps: a prefix scan.
    """
    base = fold.base_prices(listed)
    order = [F.col("cnct_id"), F.col("sad_name"), *_last(fold.RULE_ORDER), F.col("state.sbb"), F.col("state.pbb")]
    scanned = prefix_scan(stored(placed(_rows(listed, stay, base), order)), ["cnct_id"], "state", _after)
    return scanned.join(base, "cnct_id").selectExpr(
        "*", "state.step as step", "if(room_flag = 'Y', pbp_1, sbp_1) * rest_nights as room_0", "if(board_flag = 'Y', pbbp_1, sbbp_1) * rest_nights as board_0",
    ).selectExpr(
        "*", "step.keep * room_0 + step.from_b * board_0 + step.add_r as room", "board_0 + step.add_b as board",
    ).selectExpr(
        "cnct_id", "sad_name", "order", "sad_code", "rule_id", "type", "application_type", "_at",
        "if(room_flag = 'Y', 0D, room) as service_base_price",
        "if(sad_name = 'cnsr', state.sbb * rest_nights, if(board_flag = 'Y', sbbp_1 * rest_nights, board)) as service_base_board_price",
        "if(room_flag = 'Y', room, 0D) as pax_base_price",
        "if(sad_name = 'cnsr', state.pbb * rest_nights, if(board_flag = 'Y', board, pbbp_1 * rest_nights)) as pax_base_board_price",
    )


def superseded_rules(discounts: DataFrame) -> DataFrame:
    """Flag a rule (status 0) when its neighbour of the same type and application was announced later.

    ``discounts`` are matched rules; the neighbours are those of the same guest.
    """
    key = ["cnct_id", "pax_id"]
    terms = ["order", "sad_code", "rule_id", "type", "application_type", "application_initial_date", "sad_amount", "sad_percentage"]
    rows = discounts.withColumn("pax_id", F.explode("pax_ids")).select(*key, *terms)
    near = neighbours(stored(placed(rows, [*map(F.col, key), *_last(terms)])), key, F.struct("type", "application_type", "application_initial_date"))

    def supersedes(other: str) -> Column:
        o = F.col(other)
        return F.coalesce(
            (o["type"] == F.col("type"))
            & (o["application_type"] == F.col("application_type"))
            & (o["application_initial_date"] > F.col("application_initial_date")),
            F.lit(False),
        )

    status = F.when(supersedes("prev") | supersedes("next"), F.lit(0)).otherwise(F.lit(1))
    return near.select("cnct_id", "pax_id", "order", "sad_code", "rule_id", "type", "application_type",
                       status.alias("sad_status"))
