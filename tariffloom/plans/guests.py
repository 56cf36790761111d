"""Guests and the stay calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions import intervals as iv
from tariffloom.functions import party, predicates
from tariffloom.functions import weekdays as wd
from tariffloom.operators import availability as av
from tariffloom.plans.common import FAMILY, ids, query


@query
def pax_table(t) -> DataFrame:
    """Guests of every booking request, numbered by age, oldest first."""
    guests = t.table("requests").select("request_id", F.explode(party.numbered()).alias("g"))
    return guests.select("request_id", "g.pax_id", "g.age")


@query
def pax_in_range(t) -> DataFrame:
    """Guests inside the age range of each board rule; base-board rules carry the empty range, which limits nobody."""
    rng = F.when(F.col("board_code") == "BB", iv.empty_int_range()).otherwise(
        iv.closed_int_range(F.col("min_age"), F.col("max_age"))
    )
    rules = t.table("cnsr").withColumn("ages", rng)
    return rules.select(
        "rule_id",
        F.size(F.filter(FAMILY.ages_col, lambda a: iv.in_range(a, F.col("ages")))).alias("inside"),
        F.size(F.filter(FAMILY.ages_col, lambda a: iv.age_allowed(a, F.col("ages")))).alias("allowed"),
    )


@query
def pax_classify(t) -> DataFrame:
    """Guests of every request against the child ages of its contract."""
    bounds = t.table("ccon").select("file_id", "minimum_child_age", "maximum_child_age")
    parties = av.with_party(t.table("requests").join(bounds, "file_id"), F.col("ages"))
    rows = parties.select(
        "request_id", "file_id", "paxes", "adults", "childes", "infants", F.explode("guests").alias("g")
    )
    return rows.select(
        "request_id", "file_id", "paxes", "adults", "childes", "infants", "g.pax_id", "g.age",
        F.coalesce("g.child_id", F.lit(0)).alias("child_id"), F.coalesce("g.infant_id", F.lit(0)).alias("infant_id"),
    )


@query
def age_bands(t) -> DataFrame:
    """Counts and lists of children, infants and adults without a row per guest."""
    bounds = t.table("ccon").select("file_id", "minimum_child_age", "maximum_child_age")
    children, infants = party.ages_of_children(), party.ages_of_infants()
    return t.table("requests").join(bounds, "file_id").select(
        "request_id",
        F.size(children).alias("childs"), ids(F.array_sort(children)).alias("child_ages"),
        F.size(infants).alias("infants"), ids(F.array_sort(infants)).alias("infant_ages"),
        F.size(party.ages_of_adults()).alias("adults"),
    )


@query
def any_age_match(t) -> DataFrame:
    """Age bands of board rules: two quantified tests against one guest who passes both."""
    lo, hi = F.col("min_age"), F.col("max_age")
    return t.table("cnsr").select(
        "rule_id",
        predicates.any_age(FAMILY.ages_col, lo, hi).cast("int").alias("any_match"),
        F.exists(FAMILY.ages_col, lambda a: predicates.in_band(a, lo, hi)).cast("int").alias("one_guest_match"),
    )


@query
def occupancy_fit(t) -> DataFrame:
    """Three occupancy tests of the party on every room."""
    contract = av.with_party(t.table("ccon"), FAMILY.ages_col).select("file_id", "paxes", "adults", "childes")
    paxes, adults = F.col("paxes"), F.col("adults")
    between = (
        paxes.between(F.col("min_pax"), F.col("max_pax")) & adults.between(F.col("min_adult"), F.col("max_adult"))
    )
    return t.table("cnha").join(contract, "file_id").select(
        "file_id", "room_type", "characteristic", "paxes", "adults", "childes",
        between.cast("int").alias("fits_between"),
        av.fits(paxes, F.col("childes")).cast("int").alias("fits_capacity"),
        (F.col("max_pax") > paxes).cast("int").alias("fits_strictly"),
    )


def _calendar(t) -> DataFrame:
    nights = F.sequence(F.col("check_in"), F.date_sub("check_out", 1))
    return (
        t.table("requests")
        .select("request_id", F.explode(nights).alias("night"))
        .groupBy("request_id", wd.day_number(F.col("night")).alias("bk_day"))
        .agg(F.count("night").alias("count_bk_days"))
    )


@query
def stay_weekdays(t) -> DataFrame:
    """Nights per weekday of every request."""
    return _calendar(t)


@query
def weekday_map(t) -> DataFrame:
    """The same as one map per request."""
    entries = F.array_sort(F.collect_list(F.struct(
        F.col("bk_day").cast("string").alias("key"), F.col("count_bk_days").cast("string").alias("value")
    )))
    return _calendar(t).groupBy("request_id").agg(F.to_json(F.map_from_entries(entries)).alias("bk_days"))


@query
def weekday_mask(t) -> DataFrame:
    """Weekdays a board rule applies on, a dash for days off."""
    return t.table("cnsr").select("rule_id", F.array_join(wd.weekday_mask(), ",", "-").alias("week_days"))


@query
def discount_days(t) -> DataFrame:
    """Nights of the stay each discount acts on."""
    nights = F.array(*[F.lit(n) for n in FAMILY.weekdays])
    return t.table("cnsu").select(
        "rule_id", "code", "application_type",
        wd.discount_days(wd.weekday_mask(), nights, F.col("application_type")).alias("sad_days"),
    )


QUERIES = {
    "pax_table": pax_table,
    "pax_in_range": pax_in_range,
    "pax_classify": pax_classify,
    "age_bands": age_bands,
    "any_age_match": any_age_match,
    "occupancy_fit": occupancy_fit,
    "stay_weekdays": stay_weekdays,
    "weekday_map": weekday_map,
    "weekday_mask": weekday_mask,
    "discount_days": discount_days,
}
