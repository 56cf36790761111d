"""Date and age ranges as pairs of columns, half-open ``[lo, hi)`` unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlaps(a: Column, b: Column, c: Column, d: Column) -> Column:
    """SQL ``(a, b) OVERLAPS (c, d)``.

    Half-open, reversed ends are swapped, a range with equal ends is an instant that matches where it lies
    inside the other range or on its start. NULL ends give NULL (a partly known range is not resolved further).
    """
    lo1, hi1 = F.least(a, b), F.greatest(a, b)
    lo2, hi2 = F.least(c, d), F.greatest(c, d)
    known = a.isNotNull() & b.isNotNull() & c.isNotNull() & d.isNotNull()
    # the later start must lie before the other end; equal starts always meet, also for instants
    return F.when(known, (lo1 == lo2) | ((lo1 > lo2) & (lo1 < hi2)) | ((lo2 > lo1) & (lo2 < hi1)))


def intersects(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Non-empty intersection of two half-open ranges; an empty or reversed range meets nothing."""
    return (lo1 < hi2) & (lo2 < hi1) & (lo1 < hi1) & (lo2 < hi2)


def common_nights(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Nights shared by two half-open date ranges, 0 when they are apart."""
    known = lo1.isNotNull() & hi1.isNotNull() & lo2.isNotNull() & hi2.isNotNull()
    return F.when(known, F.greatest(F.datediff(F.least(hi1, hi2), F.greatest(lo1, lo2)), F.lit(0)))


def covers(lo: Column, hi: Column, start: Column, end: Column) -> Column:
    """The rule is valid for the whole stay, both ends inclusive."""
    return (lo <= start) & (hi >= end)


def covers_strictly(lo: Column, hi: Column, start: Column, end: Column) -> Column:
    """The same with both ends outside the stay."""
    return (lo < start) & (hi > end)


def valid_on(lo: Column, hi: Column, day: Column) -> Column:
    """Both bounds tested against one date."""
    return (lo < day) & (hi > day)


def open_window(lo: Column, hi: Column, now: Column) -> Column:
    """Booking window where a missing end is open."""
    return (lo.isNull() | (lo < now)) & (hi.isNull() | (hi > now))


def closed_int_range(lo: Column, hi: Column) -> Column:
    """Integer range ``[lo, hi]`` stored canonically as ``[lo, hi + 1)``; a NULL bound is unbounded."""
    return F.struct(lo.cast("int").alias("lo"), (hi + 1).cast("int").alias("hi"))


def empty_int_range() -> Column:
    """The empty range, which rules use for "no age limit"."""
    return F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi"))


def is_empty(rng: Column) -> Column:
    return F.coalesce(rng["hi"] <= rng["lo"], F.lit(False))


def in_range(x: Column, rng: Column) -> Column:
    """Scalar in a canonical range; NULL bounds are unbounded, the empty range holds nothing."""
    return (rng["lo"].isNull() | (rng["lo"] <= x)) & (rng["hi"].isNull() | (x < rng["hi"]))


def age_allowed(age: Column, rng: Column) -> Column:
    """Age limit of a rule: the empty range means no limit."""
    return is_empty(rng) | in_range(age, rng)
