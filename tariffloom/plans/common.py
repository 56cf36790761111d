"""Shared inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.functions.keys import portable
from tariffloom.operators.cache import build_cache, priced_offers
from tariffloom.params import COUPLE, FAMILY, Stay
from tariffloom.session import tune
from tariffloom.sources.answers import read_answers, write_lines
from tariffloom.sources.derived import DerivedContracts
from tariffloom.sources.sinks import stored

__all__ = ["COUPLE", "FAMILY", "contracts", "flat_range", "ids", "query", "searched_prices", "supplier_answers"]


def contracts(spark: SparkSession, sf_dir: str) -> DerivedContracts:
    return DerivedContracts(tune(spark), sf_dir)


def query(build):
    """Turn ``build(tables)`` into the registered form ``(spark, sf_dir) -> DataFrame``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(contracts(spark, sf_dir)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


def ids(col: Column | str) -> Column:
    """An array of guest numbers as text."""
    return F.coalesce(F.array_join(F.col(col) if isinstance(col, str) else col, ","), F.lit(""))


def flat_range(name: str) -> Column:
    part = lambda f: F.coalesce(F.col(name)[f].cast("string"), F.lit(""))
    return F.concat(F.lit("["), part("lo"), F.lit(","), part("hi"), F.lit(")")).alias(name)


ANY_CITY = Stay(COUPLE.check_in, COUPLE.check_out, COUPLE.ages, COUPLE.as_of)


def searched_prices(tables) -> DataFrame:
    """Priced offers of the couple's stay, stored once."""
    return stored(priced_offers(build_cache(tables), ANY_CITY))


def supplier_answers(tables, stay: Stay = COUPLE) -> tuple[DataFrame, DataFrame]:
    """The supplier's answers about a stay, read from a written export, and its broken lines."""
    lines = tables.answer_lines(stay.check_in.isoformat(), stay.check_out.isoformat())
    return read_answers(lines.sparkSession, write_lines(lines))
