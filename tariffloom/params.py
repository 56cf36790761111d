"""Search parameters: one stay window, one party of guests, one booking date."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stay:
    """What a caller asks for. Every date in a search comes from here, none is fixed in a query."""

    check_in: dt.date
    check_out: dt.date
    ages: tuple[int, ...]
    as_of: dt.date
    city_prefix: str = ""
    supplier_id: int = 5
    weekdays: tuple[int, ...] = field(init=False, default=())

    def __post_init__(self) -> None:
        if self.check_out <= self.check_in:
            raise ValueError("check_out must be after check_in")
        if not self.ages:
            raise ValueError("a party needs at least one guest")
        counts = [0] * 7
        for i in range(self.nights):
            # isoweekday: Monday 1 .. Sunday 7; the contract tables count Sunday 0 .. Saturday 6
            counts[(self.check_in + dt.timedelta(days=i)).isoweekday() % 7] += 1
        object.__setattr__(self, "weekdays", tuple(counts))

    @property
    def nights(self) -> int:
        return (self.check_out - self.check_in).days

    @property
    def lo(self) -> Column:
        return F.lit(self.check_in)

    @property
    def hi(self) -> Column:
        return F.lit(self.check_out)

    @property
    def now(self) -> Column:
        return F.lit(self.as_of)

    @property
    def ages_col(self) -> Column:
        return F.array(*[F.lit(a) for a in self.ages])


# The stays used by the registered queries (the dates lie inside the shared test tables).
FAMILY = Stay(dt.date(1998, 8, 20), dt.date(1998, 8, 26), (1, 5, 30, 30), dt.date(1998, 8, 1))
COUPLE = Stay(dt.date(1998, 8, 20), dt.date(1998, 8, 26), (30, 30), dt.date(1998, 8, 1), city_prefix="NATION_1")
