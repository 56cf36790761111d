"""Predicates of dated, wildcarded, age- and weekday-dependent rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WILD = ""  # the stored form of "any"; NULL means the same


def wild(rule: Column) -> Column:
    return rule.isNull() | (rule == WILD)


def wildcard_match(rule: Column, value: Column) -> Column:
    return wild(rule) | (rule == value)


def rule_key(rule: Column) -> Column:
    """Join key of a rule column: its value, or the wildcard mark."""
    return F.coalesce(rule, F.lit(WILD))


def rate_match(rule: Column, rate: Column) -> Column:
    """Both missing, equal, or a rule without a rate."""
    return rule.isNull() | (rule.cast("string") == rate)


def rule_rate(generic: Column, specific: Column) -> Column:
    """The rate a rule must have: the generic rate if there is one, else a specific rate other than '0'."""
    return F.nullif(F.coalesce(generic, F.nullif(specific, F.lit("0"))), F.lit(""))


def in_band(age: Column, lo: Column, hi: Column) -> Column:
    """Inclusive age band of a rule, missing bounds are open."""
    return (lo.isNull() | (lo <= age)) & (hi.isNull() | (age <= hi))


def any_age(ages: Column, lo: Column, hi: Column) -> Column:
    """Literal form of two quantified tests: some guest reaches the minimum and some guest keeps the maximum."""
    return (lo.isNull() & hi.isNull()) | (
        F.exists(ages, lambda a: lo <= a) & F.exists(ages, lambda a: hi >= a)
    )


def stay_length_strict(lo: Column, hi: Column, nights: int) -> Column:
    return (lo < nights) & (hi > nights)


def stay_length_open(lo: Column, hi: Column, nights: int) -> Column:
    return (lo.isNull() | (lo <= nights)) & (hi.isNull() | (hi >= nights))
