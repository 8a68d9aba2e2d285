"""Scalar functions (F5, F6, F8, F10-F14) as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugekeep.columns import DAYS_PER_MONTH, RELEASE_MARKER


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def release_stamp(text, marker: str = RELEASE_MARKER) -> Column:
    """The 8-digit stamp after the LAST `marker` in a page; NULL when the
    marker is absent or not followed by 8 digits."""
    t = _c(text)
    tail = F.substring(F.substring_index(t, marker, -1), 1, 8)
    return F.when(F.instr(t, marker) > 0, F.when(tail.rlike("^[0-9]{8}$"), tail))


def yyyymmdd(ts) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd")


def path_basename(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def window_start(day, months) -> Column:
    """`day` minus floor(months * 30.4167) days (18 months -> 547 days)."""
    m = F.lit(months) if not isinstance(months, Column) else months
    return F.date_sub(_c(day), F.floor(m * F.lit(DAYS_PER_MONTH)).cast("int"))


def days_between(later, earlier, digits: int = 2) -> Column:
    """(later - earlier) in days, rounded half-to-even; always days. For
    TIMESTAMP_NTZ values this is the civil difference, whatever the session
    time zone (no daylight-saving hour creeps in)."""
    diff = F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)).cast("double") / F.lit(86400e6)
    return F.bround(diff, digits)


def r_round(x, digits: int = 0) -> Column:
    """Half-to-even rounding (R's `round`)."""
    return F.bround(_c(x), digits)


def bytes_to_mb(n) -> Column:
    return F.bround(_c(n).cast("double") / F.lit(1e6), 0)


def is_leap_year(year) -> Column:
    y = _c(year)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
