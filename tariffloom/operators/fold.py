"""Ordered price fold of a rule list.

Each rule changes the price of an offer by an affine step on four numbers: room total, board total, last room
adjustment, last board adjustment. Affine steps compose associatively, so the order-dependent fold does not need
the whole rule list of an offer in one place:

1. rules are range-partitioned by (offer, order, code, rule), so a crowded offer spreads over many partitions;
2. each piece is composed to one step;
3. the pieces of an offer, at most one per partition, are composed in partition order.

Guest-type rules only add constants; general rules may reset a total, or scale the adjustment before them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import pricing as px
from tariffloom.functions.weekdays import discount_days
from tariffloom.params import Stay

# how a step acts, t = total, g = last adjustment, r = room, b = board:
#   t_r' = keep*t_r + from_b*t_b + pull_r*g_r + cross*g_b + add_r        g_r' = gain_r*g_r + set_r
#   t_b' = t_b + pull_b*g_b + add_b                                      g_b' = gain_b*g_b + set_b
COEFFICIENTS = (
    "keep", "from_b", "pull_r", "cross", "add_r", "pull_b", "add_b", "gain_r", "set_r", "gain_b", "set_b",
)
IDENTITY = {name: (1.0 if name in ("keep", "gain_r", "gain_b") else 0.0) for name in COEFFICIENTS}
# total order of the rules of an offer; the price terms settle ties between equal rule ids
RULE_ORDER = ("order", "sad_code", "rule_id", "type", "application_type", "amount", "percentage", "days")


def base_prices(listed: DataFrame) -> DataFrame:
    """One row per offer: nightly base prices, and the terms every rule of the offer refers to.

    Room prices count once per offer, board prices once per board rule. Sums are combined before the shuffle.
    """
    rows = listed.filter(F.col("sad_name") == "cnsr")
    return rows.groupBy(
        "cnct_id", "file_id", "room_type", "characteristic", "base_board", "paxes", "standard_capacity",
        "rest_nights", F.col("cnct_is_per_pax").alias("room_flag"),
    ).agg(
        F.max("service_base_price").alias("sbp_1"),
        (F.max("pax_base_price") * F.col("paxes")).alias("pbp_1"),
        F.sum("service_base_board_price").alias("sbbp_1"),
        F.sum("pax_base_board_price").alias("pbbp_1"),
        F.max("cnsr_is_per_pax").alias("board_flag"),
    )


def rules_to_price(listed: DataFrame, stay: Stay) -> DataFrame:
    """Rules with at least one night to act on."""
    nights = F.array(*[F.lit(n) for n in stay.weekdays])
    return (
        listed.filter((F.col("sad_name") == "cnsu") & F.col("sad_code").isNotNull())
        .select(
            "cnct_id", "sad_code", "order", "type", "application_type", "amount", "percentage", "times", "rule_id",
            discount_days(F.col("week_days"), nights, F.col("application_type")).alias("days"),
        )
        .filter(F.col("days") > 0)
    )


def _quoted(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# conditions on a rule and its offer, by name
_TERMS = {
    "GUEST": f"type in {_quoted(px.GUEST_TYPES)}",
    "GENERAL": f"type in {_quoted(px.GENERAL_TYPES)}",
    "ON_ROOM": f"application_type in {_quoted(px.ROOM_APPLICATIONS)}",
    "ON_BOARD": f"application_type in {_quoted(px.BOARD_APPLICATIONS)} and board_flag is not null",
    "ABSOLUTE": f"application_type = '{px.ABSOLUTE}' and HAS_AMOUNT",
    "PLUS_BOARD": f"application_type = '{px.ABSOLUTE_PLUS_BOARD}' and HAS_AMOUNT and board_flag is not null",
    "HAS_AMOUNT": "coalesce(amount, 0) <> 0",
    "HAS_PERCENT": "coalesce(percentage, 0) <> 0",
    "ROOM_Y": "room_flag = 'Y'",
    "BOARD_Y": "board_flag = 'Y'",
}


def _cases(*branches: tuple[str, str], default: str) -> str:
    """First branch whose named conditions hold."""
    text = " ".join(f"when {condition} then {value}" for condition, value in branches)
    for _ in range(2):  # a condition may name another one
        for name, sql in _TERMS.items():
            text = re.sub(rf"\b{name}\b", f"({sql})", text)
    return f"cast(case {text} else {default} end as double)"


# what a guest-type rule adds to the totals, for every guest it meets; p and c are guests and room capacity
GUEST_ADDS_ROOM = _cases(
    ("ON_ROOM and HAS_AMOUNT", "times * days * amount / p"),
    ("ON_ROOM and HAS_PERCENT and ROOM_Y", "times * days * percentage / 100 * pbp_1 / p"),
    ("ON_ROOM and HAS_PERCENT", "times * days * percentage / 100 * sbp_1 / c"),
    ("ABSOLUTE and ROOM_Y", "times * days * (amount - pbp_1) / p"),
    ("ABSOLUTE", "times * days * (amount / p - sbp_1 / c)"),
    ("PLUS_BOARD and ROOM_Y and BOARD_Y", "times * days * (amount / p - pbp_1 / p + sbbp_1)"),
    ("PLUS_BOARD and ROOM_Y", "times * days * (amount - pbp_1 + pbbp_1) / p"),
    ("PLUS_BOARD and BOARD_Y", "times * days * (amount / p - pbp_1 / c + pbbp_1)"),
    ("PLUS_BOARD", "times * days * (amount / p - pbp_1 / c + sbbp_1 / c)"),
    default="0",
)
GUEST_ADDS_BOARD = _cases(
    ("ON_BOARD and HAS_AMOUNT", "times * days * amount / p"),
    ("ON_BOARD and HAS_PERCENT and BOARD_Y", "times * days * percentage / 100 * pbbp_1 / p"),
    ("ON_BOARD and HAS_PERCENT", "times * days * percentage / 100 * sbbp_1 / c"),
    default="0",
)

# The coefficients of a rule's step. A total whose board flag the offer does not have never changes, so it enters
# an absolute rule as a constant; the other one enters through ``from_b``.
STEP = {
    "keep": _cases(("GENERAL and (ABSOLUTE or PLUS_BOARD)", "0"), default="1"),
    "from_b": _cases(
        ("GENERAL and PLUS_BOARD and ROOM_Y and BOARD_Y", "days"),
        ("GENERAL and PLUS_BOARD and not ROOM_Y and not BOARD_Y", "days / c"),
        default="0",
    ),
    "pull_r": _cases(("GENERAL and ON_ROOM and not HAS_AMOUNT and HAS_PERCENT", "percentage / 100"), default="0"),
    "cross": "0D",
    "add_r": _cases(
        ("GUEST", GUEST_ADDS_ROOM),
        ("GENERAL and HAS_AMOUNT and (ON_ROOM or ABSOLUTE)", "days * amount"),
        ("GENERAL and PLUS_BOARD and ROOM_Y and not BOARD_Y", "days * (amount + pbbp_1 * rest_nights / p)"),
        ("GENERAL and PLUS_BOARD and not ROOM_Y and BOARD_Y", "days * (amount + sbbp_1 * rest_nights)"),
        ("GENERAL and PLUS_BOARD", "days * amount"),
        default="0",
    ),
    "pull_b": _cases(("GENERAL and ON_BOARD and not HAS_AMOUNT and HAS_PERCENT", "percentage / 100"), default="0"),
    "add_b": _cases(
        ("GUEST", GUEST_ADDS_BOARD), ("GENERAL and ON_BOARD and HAS_AMOUNT", "days * amount"), default="0"
    ),
    "gain_r": _cases(
        ("GENERAL and ON_ROOM and HAS_AMOUNT", "0"), ("GENERAL and ON_ROOM and HAS_PERCENT", "percentage / 100"),
        default="1",
    ),
    "set_r": _cases(("GENERAL and ON_ROOM and HAS_AMOUNT", "days * amount"), default="0"),
    "gain_b": _cases(
        ("GENERAL and ON_BOARD and HAS_AMOUNT", "0"), ("GENERAL and ON_BOARD and HAS_PERCENT", "percentage / 100"),
        default="1",
    ),
    "set_b": _cases(("GENERAL and ON_BOARD and HAS_AMOUNT", "days * amount"), default="0"),
}


def with_base(rules: DataFrame, base: DataFrame) -> DataFrame:
    """Rules next to the base prices of their offer."""
    return rules.join(base, "cnct_id").selectExpr(
        "*", "nullif(paxes, 0) as p", "nullif(standard_capacity, 0) as c"
    )


def steps(rules: DataFrame, base: DataFrame) -> DataFrame:
    """One affine step per offer and rule."""
    return with_base(rules, base).selectExpr(
        "cnct_id", *RULE_ORDER, *[f"{sql} as {name}" for name, sql in STEP.items()]
    )


# composition of step a with the step b after it
_THEN = {
    "keep": "b.keep * a.keep",
    "from_b": "b.keep * a.from_b + b.from_b",
    "pull_r": "b.keep * a.pull_r + b.pull_r * a.gain_r",
    "cross": "b.keep * a.cross + b.from_b * a.pull_b + b.cross * a.gain_b",
    "add_r": "b.keep * a.add_r + b.from_b * a.add_b + b.pull_r * a.set_r + b.cross * a.set_b + b.add_r",
    "pull_b": "a.pull_b + b.pull_b * a.gain_b",
    "add_b": "a.add_b + b.pull_b * a.set_b + b.add_b",
    "gain_r": "b.gain_r * a.gain_r",
    "set_r": "b.gain_r * a.set_r + b.set_r",
    "gain_b": "b.gain_b * a.gain_b",
    "set_b": "b.gain_b * a.set_b + b.set_b",
}


def then(first: Column, second: Column) -> Column:
    """The step that does what ``first`` does and ``second`` after it."""
    def value(text: str) -> Column:
        total = None
        for product in text.split(" + "):
            term = None
            for factor in product.split(" * "):
                side, name = factor.split(".")
                part = (first if side == "a" else second)[name]
                term = part if term is None else term * part
            total = term if total is None else total + term
        return total

    return F.struct(*[value(_THEN[n]).alias(n) for n in COEFFICIENTS])


def _compose(ordered: str) -> Column:
    """The steps of a sorted array as one step."""
    start = ", ".join(f"{IDENTITY[n]}D as {n}" for n in COEFFICIENTS)
    merge = ", ".join(f"{_THEN[n]} as {n}" for n in COEFFICIENTS)
    return F.expr(f"aggregate({ordered}, struct({start}), (a, b) -> struct({merge}))")


def composed(stepped: DataFrame, pieces: int | None = None) -> DataFrame:
    """One step per offer. ``pieces`` fixes the number of range partitions; by default Spark sizes them."""
    order = [f"{name} {part}".strip() for name in RULE_ORDER for part in ("is null", "")]
    spread = [F.col("cnct_id"), *[F.expr(o) for o in order]]
    ranged = stepped.repartitionByRange(pieces, *spread) if pieces else stepped.repartitionByRange(*spread)
    fields = ", ".join([f"{o} as o{i}" for i, o in enumerate(order)] + list(COEFFICIENTS))
    parts = (
        ranged.withColumn("piece", F.spark_partition_id())
        .groupBy("cnct_id", "piece")
        .agg(_compose(f"array_sort(collect_list(struct({fields})))").alias("step"))
    )
    in_order = "transform(array_sort(collect_list(struct(piece, step))), x -> x.step)"
    return parts.groupBy("cnct_id").agg(_compose(in_order).alias("step"))


def fold_prices(listed: DataFrame, stay: Stay, pieces: int | None = None) -> DataFrame:
    """Five prices per offer; every offer of the list comes out once, under its own ids."""
    base = base_prices(listed)
    folded = composed(steps(rules_to_price(listed, stay), base), pieces)
    start = base.join(folded, "cnct_id", "left").selectExpr(
        "*",
        "if(room_flag = 'Y', pbp_1, sbp_1) * rest_nights as room_0",
        "if(board_flag = 'Y', pbbp_1, sbbp_1) * rest_nights as board_0",
    )
    ended = start.selectExpr(
        "*",
        "coalesce(step.keep * room_0 + step.from_b * board_0 + step.add_r, room_0) as room",
        "coalesce(board_0 + step.add_b, board_0) as board_total",
    )
    return ended.selectExpr(
        "cnct_id", "file_id", "room_type", "characteristic", "base_board as board",
        "if(room_flag = 'Y', 0D, room) as sbprice",
        "if(board_flag = 'Y', sbbp_1 * rest_nights, board_total) as sbbprice",
        "if(room_flag = 'Y', room, 0D) as pbprice",
        "if(board_flag = 'Y', board_total, pbbp_1 * rest_nights) as pbbprice",
    ).selectExpr("*", "sbprice + sbbprice + pbprice + pbbprice as total_price")
