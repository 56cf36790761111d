"""Board and rule terms of an offer, as arrays, as JSON, and as prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listed_terms(df: DataFrame, key: list[str], term: list[str], name: str = "terms") -> DataFrame:
    """All terms of a group as one sorted array of structs, duplicates and NULL terms kept.

    Equal terms are counted before anything is collected, so a group only ever gathers its distinct terms; the
    array is written out at the end, in the row it belongs to.
    """
    counted = df.groupBy(*key, *term).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    gathered = counted.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct(F.struct(*term).alias("term"), F.col("copies")))).alias("counted")
    )
    full = F.flatten(F.transform("counted", lambda x: F.array_repeat(x["term"], x["copies"])))
    return gathered.select(*key, full.alias(name))


def as_json(col: Column) -> Column:
    """JSON text with NULL fields written out."""
    return F.to_json(col, {"ignoreNullFields": "false"})


def from_json_text(col: Column, fields: str) -> Column:
    """Stored JSON terms back as an array of structs; text that isn't such an array becomes NULL."""
    return F.from_json(col, f"array<struct<{fields}>>")


def counted_codes(df: DataFrame, key: list[str], code: str, name: str) -> DataFrame:
    """All codes of a group in order, as one text."""
    return listed_terms(df.filter(F.col(code).isNotNull()), key, [code], "codes").select(
        *key, F.array_join(F.transform("codes", lambda c: c[code]), ",").alias(name)
    )


def as_dictionary(listed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``listed`` with ``<name>_id`` in place of the text ``name``, and the dictionary (``<name>_id``, ``name``) that has each distinct text once.
    What refers to a list then carries its 32 characters of id, however long the list is."""
    key = f"{name}_id"
    coded = listed.withColumn(key, F.md5(name))
    return coded.drop(name), coded.filter(F.col(name).isNotNull()).groupBy(key).agg(F.any_value(name).alias(name))


def board_grouping_sets(boards: DataFrame) -> DataFrame:
    """Per offer of ``boards`` (the left join of offers and board rules): one row for the room itself with the board columns empty, and one row per board term.

    Both grouping sets come from one scan of the matched rules and are combined before the shuffle.
    """
    key = ["cnct_id", "file_id"]
    room = ["room_type", "characteristic", "base_board"]
    board = ["board_code", "cnsr_is_per_pax", "cnsr_amount", "cnsr_percentage"]
    rows = boards.select(*key, *room, *board)
    cols = lambda names: [F.col(n) for n in names]
    grouped = rows.groupingSets([cols(key + room), cols(key + board)], *cols(key + room + board)).agg(
        F.count(F.lit(1)).alias("rules"),
        F.grouping("base_board").cast("int").alias("is_board_row"),
    )
    return grouped.select(
        *key, *room, F.col("board_code"), "cnsr_is_per_pax", "cnsr_amount", "cnsr_percentage", "rules",
        "is_board_row", F.coalesce("base_board", "board_code").alias("board"),
    )
