"""Overlap of dated rows as an equi-join on bins.

Two ranges overlap in exactly one of two ways: the left one begins inside the right one, or the right one begins inside the left one,
later. In each way the side that begins inside the other has one bin, that of its start, and the other side has the bins it
covers. So every overlapping pair meets once and needs no clean-up, and what meets without overlapping are only rows that share
a bin at the end of a range.

Bins are ``DAYS`` long. A range of more than ``MOST`` bins uses coarse ones, ``MOST`` * ``MOST`` times as long, so that no dirty date makes many
rows; starts stand in a bin of either size. Empty, reversed and half-known ranges have no bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS, MOST = 64, 16
COARSE = DAYS * MOST * MOST
STARTS, COVERS = 0, 1  # ways to meet, seen from the left side


def _bin(day: Column, size: int) -> Column:
    return F.floor(F.unix_date(day) / size).cast("long")


def _slots(bins: Column, coarse: bool, way: int) -> Column:
    return F.transform(bins, lambda b: b * 4 + (2 if coarse else 0) + way)


def _start_slots(lo: Column, way: int) -> Column:
    return F.concat(_slots(F.array(_bin(lo, DAYS)), False, way), _slots(F.array(_bin(lo, COARSE)), True, way))


def _cover_slots(lo: Column, hi: Column, way: int) -> Column:
    last = F.date_sub(hi, 1)
    return F.when(F.datediff(hi, lo) <= DAYS * MOST, _slots(F.sequence(_bin(lo, DAYS), _bin(last, DAYS)), False, way)).otherwise(
        _slots(F.sequence(_bin(lo, COARSE), _bin(last, COARSE)), True, way))


def _known(lo: Column, hi: Column, slots: Column) -> Column:
    return F.when(lo < hi, slots).otherwise(F.array().cast("array<long>"))


def left_slots(lo: Column, hi: Column) -> Column:
    """Numbers of the bins in which a row of the left side meets rows of the right one."""
    return _known(lo, hi, F.concat(_start_slots(lo, STARTS), _cover_slots(lo, hi, COVERS)))


def right_slots(lo: Column, hi: Column) -> Column:
    return _known(lo, hi, F.concat(_cover_slots(lo, hi, STARTS), _start_slots(lo, COVERS)))


def overlapping(slot: Column, lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Whether a pair that met in a slot overlaps in the way of that slot."""
    starts = (slot.bitwiseAND(1) == STARTS) & (lo1 >= lo2) & (lo1 < hi2)
    covers = (slot.bitwiseAND(1) == COVERS) & (lo2 > lo1) & (lo2 < hi1)
    return starts | covers


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], ends: tuple[str, str, str, str]) -> DataFrame:
    """Inner join on ``keys`` and the overlap of [lo1, hi1) of the left side with [lo2, hi2) of the right side, ``ends`` their names."""
    lo1, hi1, lo2, hi2 = map(F.col, ends)
    a = left.withColumn("_slot", F.explode(left_slots(lo1, hi1)))
    b = right.withColumn("_slot", F.explode(right_slots(lo2, hi2)))
    return a.join(b, [*keys, "_slot"]).filter(overlapping(F.col("_slot"), lo1, hi1, lo2, hi2)).drop("_slot")
