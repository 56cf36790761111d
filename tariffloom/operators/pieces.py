"""Rows in one global order, cut into pieces of about equal size: the ground for scans that no key keeps in one task.

``placed`` range-partitions rows by bounded sort columns and numbers them where they lie. A piece is a partition; a key with a
third of all rows spans many pieces, nearly every other key lies in one. Running values are taken inside (key, piece) and
carried over the cuts, a row a (key, piece) of which at most one a piece has anything to carry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE, KEY = "_piece", "_key"


class Running(NamedTuple):
    """An aggregate that can be split: over rows, over the totals of earlier pieces, and both together."""

    rows: Column
    totals: Callable[[str], Column]
    joined: Callable[[Column, Column], Column]  # of what the earlier pieces give, and of the rows of this one


def running_sum(value: Column) -> Running:
    zero = F.lit(0)
    return Running(F.sum(value), F.sum, lambda a, b: F.coalesce(a, zero) + F.coalesce(b, zero))


def running_xor(value: Column) -> Running:
    zero = F.lit(0).cast("long")
    return Running(F.bit_xor(value), F.bit_xor, lambda a, b: F.coalesce(a, zero).bitwiseXOR(F.coalesce(b, zero)))


def running_last(value: Column) -> Running:
    """The last row's value; NULL values count."""
    return Running(F.last(F.struct(value.alias("v"))), lambda c: F.last(c, True), lambda a, b: F.coalesce(b, a)["v"])


def placed(rows: DataFrame, order: Sequence[Column], keep: Sequence[str] | None = None) -> DataFrame:
    """``rows`` (their columns ``keep``) with ``_at``, a long that ascends with ``order``. The cuts are sampled anew at each run: write the
    result before it is used. Sampled sort columns pass the driver, so they must be short."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select(*(keep or rows.columns), F.monotonically_increasing_id().alias("_at"))


def running(rows: DataFrame, key: Sequence[str], values: dict[str, Running], past: bool = False) -> DataFrame:
    """``rows`` (placed by ``key`` and what orders it, and written) with the running ``values`` of each key, a row included or, with
    ``past``, up to the row before it.

    Rows are dealt by (key, piece), once: totals of a piece come from the same windows, and what earlier pieces carry is joined where
    the rows lie. Keys are compared as structs, in which NULLs are equal. No join is forced to be a broadcast.
    """
    rows = rows.withColumns({PIECE: F.shiftright("_at", 33), KEY: F.struct(*[f"`{c}`" for c in key])})
    group = Window.partitionBy(KEY, PIECE)
    upto = group.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1 if past else Window.currentRow)
    whole = group.orderBy("_at").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    held = list(values.items())
    # the first row of a piece's key sees the whole piece
    firsts = rows.select(KEY, PIECE, F.row_number().over(group.orderBy("_at")).alias("_n"), *[
        v.rows.over(whole).alias(f"_v{i}") for i, (_, v) in enumerate(held)]).filter("_n = 1")
    earlier = Window.partitionBy(KEY).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carry = firsts.select(KEY, PIECE, F.lag(PIECE).over(Window.partitionBy(KEY).orderBy(PIECE)).alias("_from"), *[
        v.totals(f"_v{i}").over(earlier).alias(f"_c{i}") for i, (_, v) in enumerate(held)]).filter("_from IS NOT NULL").drop("_from")
    local = rows.select("*", *[v.rows.over(upto).alias(f"_l{i}") for i, (_, v) in enumerate(held)])
    met = local.join(carry, [KEY, PIECE], "left")
    return met.select(*[f"`{c}`" for c in rows.columns if c not in (PIECE, KEY)], *[
        v.joined(F.col(f"_c{i}"), F.col(f"_l{i}")).alias(name) for i, (name, v) in enumerate(held)])


def neighbours(rows: DataFrame, key: Sequence[str], value: Column) -> DataFrame:
    """``rows`` (placed by ``key`` and what orders it, and written) with ``prev`` and ``next``: ``value`` of the rows before and after, NULL at a
    key's ends. Inside a piece by its windows; over the cuts the last and the first value of each (key, piece) are exchanged."""
    rows = rows.withColumns({PIECE: F.shiftright("_at", 33), KEY: F.struct(*[f"`{c}`" for c in key]), "_v": value})
    group = Window.partitionBy(KEY, PIECE).orderBy("_at")
    ends = rows.select(KEY, PIECE, F.row_number().over(group).alias("_n"), F.col("_v").alias("_first"), F.last("_v").over(
        group.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("_last")).filter("_n = 1")
    across = Window.partitionBy(KEY).orderBy(PIECE)
    edges = ends.select(KEY, PIECE, F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after"))
    local = rows.select("*", F.lag("_v").over(group).alias("_lag"), F.lead("_v").over(group).alias("_lead"))
    met = local.join(edges, [KEY, PIECE])
    return met.select(*[f"`{c}`" for c in rows.columns if c not in (PIECE, KEY, "_v")], F.coalesce("_lag", "_before").alias("prev"), F.coalesce(
        "_lead", "_after").alias("next"))


def prefix_scan(rows: DataFrame, key: Sequence[str], value: str, joined: Callable[[Column, Column], Column]) -> DataFrame:
    """``rows`` (placed by ``key`` and what orders it, and written), ``value`` replaced by its prefix: the values of the key up to the row, put together
    by ``joined(earlier, later)``, which must be associative and need not commute.

    By doubling: after k rounds a row holds its last 2^k values, each round a lag in one and the same window, so that rows are dealt and
    sorted once. Pieces are scanned first; their totals, a row a (key, piece), are scanned in the same way and joined back.
    """
    rows = rows.withColumns({PIECE: F.shiftright("_at", 33), KEY: F.struct(*[f"`{c}`" for c in key])})
    sizes = rows.groupBy(KEY, PIECE).agg(F.count(F.lit(1)).alias("n")).groupBy(KEY).agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("p"))
    longest, most = sizes.agg(F.max("n"), F.max("p")).first()

    def scanned(df: DataFrame, group: list[str], order: str, size: int) -> DataFrame:
        window, step = Window.partitionBy(*group).orderBy(order), 1
        while step < size:
            df = df.withColumn("_earlier", F.lag(value, step).over(window))
            df = df.withColumn(value, F.when(F.col("_earlier").isNull(), F.col(value)).otherwise(joined(F.col("_earlier"), F.col(value))))
            step *= 2
        return df.drop("_earlier")

    local = scanned(rows, [KEY, PIECE], "_at", longest or 0)
    if (most or 0) < 2:
        return local.drop(PIECE, KEY)
    ends = local.groupBy(KEY, PIECE).agg(F.max_by(value, "_at").alias(value))
    across = scanned(ends, [KEY], PIECE, most)
    before = across.select(KEY, PIECE, F.lag(value).over(Window.partitionBy(KEY).orderBy(PIECE)).alias("_before"))
    met = local.join(before, [KEY, PIECE])
    both = F.when(F.col("_before").isNull(), F.col(value)).otherwise(joined(F.col("_before"), F.col(value)))
    return met.withColumn(value, both).drop(PIECE, KEY, "_before")
