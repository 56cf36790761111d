"""Room-type dictionary and the two joins whose keys are not plain columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.functions.keys import md5_key
from tariffloom.operators.availability import ROOM


def prefix_join(left: DataFrame, text: str, names: DataFrame, name: str) -> DataFrame:
    """Left join where ``text`` starts with ``upper(name)``.

    Each text offers its prefixes of the lengths that names have (a handful), so this is an equi-join instead of
    a nested loop over both sides. Texts without a name stay.
    """
    known = names.select(F.upper(name).alias("prefix"), F.col(name))
    lengths = known.agg(F.collect_set(F.length("prefix")).alias("lengths")).scalar()
    tried = (
        left.select(text).distinct()
        .withColumn("n", F.explode(lengths))
        .filter(F.col("n") <= F.length(text))
        .select(text, F.substring(F.col(text), F.lit(1), F.col("n")).alias("prefix"))
    )
    hits = tried.join(known, "prefix").drop("prefix")
    return left.join(hits, text, "left")


def described_rooms(cnha: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rooms with the dictionary title of room and characteristic, else the title of the room type."""
    titles = dictionary.select("room_type", F.upper("rt_title").alias("rt_title")).distinct()
    own = dictionary.select("room_type", "characteristic", "title")
    return (
        cnha.join(own, ["room_type", "characteristic"], "left")
        .join(titles, "room_type", "left")
        .withColumn("description", F.coalesce("title", "rt_title"))
        .drop("title", "rt_title")
    )


def room_types(cnha: DataFrame, dictionary: DataFrame, names: DataFrame) -> DataFrame:
    rooms = described_rooms(cnha, dictionary).withColumn("rt_id", md5_key(*ROOM, sep=":"))
    return prefix_join(rooms, "description", names, "name_en").withColumnRenamed("name_en", "accommodation_type")


def or_join(prices: DataFrame, cnsu: DataFrame) -> DataFrame:
    """Join on ``same contract, room and characteristic  OR  same room, no characteristic  OR  neither, type N``,
    reduced to what it does to a price row: how often the row comes out, and the amounts it meets.

    Which columns a rule leaves empty decides its branch, so the branches are disjoint. Each is aggregated before
    the join: two equi-joins on unique keys and one single row, never the pairs themselves. The sums meet on the
    distinct rooms, so the price facts are only shuffled by room, never by the few room types.
    """
    room, char = F.col("room_type"), F.col("characteristic")

    def summed(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"n_{tag}"), F.sum(F.col("amount").cast("double")).alias(f"amount_{tag}")
        )

    exact = summed(cnsu.filter(room.isNotNull() & char.isNotNull()), ROOM, "exact")
    by_room = summed(cnsu.filter(room.isNotNull() & char.isNull()), ["room_type"], "room")
    anywhere = cnsu.filter(room.isNull() & char.isNull() & (F.col("type") == "N"))
    wild_n = anywhere.agg(F.count(F.lit(1))).scalar()
    wild_amount = anywhere.agg(F.sum(F.col("amount").cast("double"))).scalar()

    def zero(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    per_room = (
        prices.select(*ROOM).distinct()
        .join(exact, ROOM, "left")
        .join(by_room, "room_type", "left")
        .select(
            *ROOM,
            (zero("n_exact") + zero("n_room") + F.coalesce(wild_n, F.lit(0))).alias("rules"),
            (zero("amount_exact") + zero("amount_room") + F.coalesce(wild_amount, F.lit(0.0))).alias("rule_amount"),
        )
    )
    return prices.join(per_room, ROOM).withColumn("copies", F.greatest("rules", F.lit(1)))
