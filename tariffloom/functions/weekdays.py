"""Weekday masks. Day numbers run from Sunday 0 to Saturday 6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: flag columns of the rule tables in day-number order
DAY_FLAGS = ("on_sunday", "on_monday", "on_tuesday", "on_wednesday", "on_thursday", "on_friday", "on_saturday")

# fixed values: application types that act once per stay, whatever the weekday
ONCE_PER_STAY = ("T", "U")


def day_number(date: Column) -> Column:
    return F.dayofweek(date) - 1


def weekday_mask(prefix: str = "") -> Column:
    """Seven entries, the day number where the flag is 'Y', NULL elsewhere."""
    return F.expr("array(" + ", ".join(f"if({prefix}{name} = 'Y', {i}, null)" for i, name in enumerate(DAY_FLAGS)) + ")")


def days_in_mask(mask: Column, counts: Column) -> Column:
    """Stay nights that fall on a weekday of the mask; ``counts`` holds the nights per day number."""
    days_on = F.filter(mask, lambda d: d.isNotNull())
    return F.aggregate(days_on, F.lit(0), lambda acc, d: acc + F.element_at(counts, d + 1))


def discount_days(mask: Column, counts: Column, application_type: Column) -> Column:
    """Nights a rule acts on: once for per-stay application types, else the masked nights of the stay."""
    return F.when(application_type.isin(*ONCE_PER_STAY), F.lit(1)).otherwise(days_in_mask(mask, counts))
