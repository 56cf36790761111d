"""Price formulas of rooms, boards and rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: rule types that act per guest, and rule types that act on the whole offer
GUEST_TYPES = ("N", "C", "I", "F")
GENERAL_TYPES = ("B", "K", "U", "L", "M", "O", "E", "V", "G")
# fixed values: application types that act on the room price, and on the board price
ROOM_APPLICATIONS = ("B", "N", "T", "U")
BOARD_APPLICATIONS = ("R", "N", "T", "U")
ABSOLUTE, ABSOLUTE_PLUS_BOARD = "A", "M"
# fixed values: sort ranks of base rows and of free-night rows in a rule list
BASE_RANK, FREE_NIGHT_RANK = -100000, 100000


def present(x: Column) -> Column:
    """0 and NULL both mean that the term is not set."""
    return F.coalesce(x != 0, F.lit(False))


def _zero_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def service_base_price(amount: Column, room_flag: Column) -> Column:
    return F.when(room_flag == "N", amount).otherwise(F.lit(0.0))


def pax_base_price(amount: Column, room_flag: Column, paxes: Column) -> Column:
    """Share of one paying guest."""
    return F.when(room_flag == "Y", amount / F.nullif(paxes, F.lit(0))).otherwise(F.lit(0.0))


def service_board_price(
    room_amount: Column, room_flag: Column, capacity: Column, amount: Column, pct: Column, board_flag: Column
) -> Column:
    """Board price for the room as a whole, from one board rule."""
    share = F.when(room_flag == "Y", room_amount * capacity).otherwise(room_amount)
    by_service = board_flag == "N"
    return (
        F.when(by_service & present(amount), amount)
        .when(by_service & present(pct), share * pct / 100)
        .otherwise(F.lit(0.0))
    )


def pax_board_price(
    room_amount: Column, room_flag: Column, capacity: Column, paxes: Column,
    amount: Column, pct: Column, board_flag: Column, billed: Column,
) -> Column:
    """Board price of all ``billed`` guests, from one board rule."""
    per_guest = F.when(room_flag == "Y", room_amount / F.nullif(paxes, F.lit(0))).otherwise(
        room_amount / F.nullif(capacity, F.lit(0))
    )
    by_guest = board_flag == "Y"
    return (
        F.when(by_guest & present(amount), amount * billed)
        .when(by_guest & present(pct), per_guest * pct / 100 * billed)
        .otherwise(F.lit(0.0))
    )


def room_total(amount: Column, room_flag: Column, guests: Column) -> Column:
    return F.when(room_flag == "Y", amount * guests).otherwise(amount)


def board_term(
    room: Column, room_flag: Column, capacity: Column, guests: Column, amount: Column, pct: Column, board_flag: Column
) -> Column:
    """One board term on top of the room total; ``pct`` is in percent."""
    share = pct / 100
    return (
        F.when(present(amount) & (board_flag == "N"), amount)
        .when(present(amount) & (board_flag == "Y"), amount * guests)
        .when(present(pct) & (board_flag == "N") & (room_flag == "N"), room * share)
        .when(present(pct) & (board_flag == "Y") & (room_flag == "N"), room * share / capacity * guests)
        .when(present(pct) & (room_flag == "Y"), room * share * capacity)
        .otherwise(F.lit(0.0))
    )


def room_and_board(amount: Column, room_flag: Column, terms: Column, guests: Column, capacity: Column,
                   board_flag: Column | None = None) -> Column:
    """Room and board price of an offer as one struct."""
    room = room_total(amount, room_flag, guests)
    return F.struct(
        room.alias("rt_price"),
        board_total(terms, room, room_flag, capacity, guests, board_flag).alias("board_price"),
    )


def board_total(terms: Column, room: Column, room_flag: Column, capacity: Column, guests: Column,
                board_flag: Column | None = None) -> Column:
    """All terms of an array of ``(amount, pct[, flag])`` structs added up; the flag may stand outside the array."""
    return F.aggregate(
        terms,
        F.lit(0.0),
        lambda acc, t: acc + board_term(
            room, room_flag, capacity, guests, t["amount"], t["pct"],
            t["flag"] if board_flag is None else board_flag,
        ),
    )
