"""Guests of one party against the child-age bounds of a contract, without a cross join.

The party is a short array carried by the row, so classifying it needs neither a join nor a shuffle. The
expressions read the columns ``ages``, ``minimum_child_age`` and ``maximum_child_age``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHILD = "between minimum_child_age and maximum_child_age"
_INFANT = "< minimum_child_age"
_NUMBERED = "transform(reverse(array_sort(ages)), (a, i) -> struct(i + 1 as pax_id, a as age))"


def _ordinal(band: str) -> str:
    """Position of guest ``g`` in a band, youngest first, ties by guest number.

    Guests of one age are numbered in a row behind all older ones, so counting younger members of the band and
    older guests of the party is enough; nothing is sorted per guest.
    """
    younger = f"size(filter(ages, a -> a {band} and a < g.age))"
    older = "size(filter(ages, a -> a > g.age))"
    return f"if(g.age {band}, {younger} + g.pax_id - {older}, null)"


def numbered() -> Column:
    """Guest number 1.. by age, oldest first."""
    return F.expr(_NUMBERED)


def classified() -> Column:
    """Array of guests with their child and infant ordinals (NULL where a guest is neither)."""
    return F.expr(
        f"transform({_NUMBERED}, g -> struct(g.pax_id as pax_id, g.age as age, "
        f"{_ordinal(_CHILD)} as child_id, {_ordinal(_INFANT)} as infant_id))"
    )


def ages_of_children() -> Column:
    return F.expr(f"filter(ages, a -> a {_CHILD})")


def ages_of_infants() -> Column:
    return F.expr(f"filter(ages, a -> a {_INFANT})")


def ages_of_adults() -> Column:
    """Adult from the first age above the child bound: no age falls between the bands."""
    return F.expr("filter(ages, a -> a > maximum_child_age)")
