"""Event-time tumbling windows (STR-7..9) and their text form (FN-1, FN-2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's three grains (size and offset in days) and its
# window-start text format.
WINDOW_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Grain:
    """A tumbling window of ``size_days`` whose boundaries sit at ``offset_days``
    past the epoch (UTC)."""

    label: str
    size_days: int
    offset_days: int = 0

    def __post_init__(self) -> None:
        if self.size_days <= 0 or not 0 <= self.offset_days < self.size_days:
            raise ValueError(f"need size > 0 and 0 <= offset < size, got {self.size_days}/{self.offset_days}")

    @property
    def size(self) -> str:
        return f"{self.size_days} days"

    @property
    def offset(self) -> str:
        return f"{self.offset_days} days"

    def window(self, ts: str | Column = "ts") -> Column:
        """The ``struct<start,end>`` window column for an event-time column."""
        if self.offset_days:
            return F.window(ts, self.size, self.size, self.offset)
        return F.window(ts, self.size)

    def window_of(self, ts: str | Column) -> Column:
        """The same ``struct<start,end>`` as :meth:`window`, by arithmetic on
        epoch microseconds.  Usable where Spark refuses a second ``window()``
        in one projection (e.g. mapping a fine window start to several grains)."""
        c = F.col(ts) if isinstance(ts, str) else ts
        size = self.size_days * 86_400_000_000
        off = self.offset_days * 86_400_000_000
        us = F.unix_micros(c)
        start = us - F.pmod(us - F.lit(off), F.lit(size))
        return F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + F.lit(size)).alias("end"))

    def contains(self, finer: "Grain") -> bool:
        """True if every window of ``finer`` lies inside one window of self,
        which makes a roll-up of finer partial results exact."""
        return (
            self.size_days % finer.size_days == 0
            and (self.offset_days - finer.offset_days) % finer.size_days == 0
        )

    def duckdb_bucket(self, ts: str = "ts") -> str:
        """The same window start as a DuckDB expression (used by the oracles)."""
        return (
            f"time_bucket(INTERVAL '{self.size_days} days', {ts}, "
            f"TIMESTAMP '1970-01-01' + INTERVAL '{self.offset_days} days')"
        )


# 1 day; 3 days at offset 2; "all time" = 23 days at offset 13.
DAY = Grain("1day", 1, 0)
THREE_DAYS = Grain("3days", 3, 2)
ALL_TIME = Grain("alltime", 23, 13)
GRAINS = (DAY, THREE_DAYS, ALL_TIME)


def window_text(c: str | Column) -> Column:
    """FN-1 / FN-2: a window bound as ``yyyy-MM-dd HH:mm:ss`` in the session zone (UTC)."""
    return F.date_format(c, WINDOW_TEXT_FORMAT)
