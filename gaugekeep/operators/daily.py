"""Daily aggregates: realtime daily mean (A2), daily mean with first-row
attributes (A1), earliest day over several tables (A3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, PARAMETER, STATION, VALUE
from gaugekeep.functions.columns import civil_day

NULL_POLICIES = ("skip", "poison")


def clean_value(v) -> Column:
    """NaN counts as missing: turn it into NULL so that avg skips it."""
    c = F.col(v) if isinstance(v, str) else v
    return F.nanvl(c, F.lit(None).cast("double"))


def _mean(v: Column, null_policy: str) -> Column:
    if null_policy == "skip":
        return F.avg(v)
    if null_policy == "poison":
        # any missing reading makes the day's mean missing
        return F.when(F.count(v) == F.count(F.lit(1)), F.avg(v))
    raise ValueError(f"null_policy must be one of {NULL_POLICIES}")


def realtime_daily_mean(readings: DataFrame, time_col: str = DATE, null_policy: str = "skip",
                        keys=(STATION, PARAMETER), extra_keys=()) -> DataFrame:
    """One row per (station, civil day, parameter) with the mean Value.

    `extra_keys` are columns that depend on the station only (carried along
    as grouping keys). Partial aggregation runs before the shuffle, so only one
    row per key and input partition travels."""
    day = civil_day(time_col).alias(DATE)
    v = clean_value(VALUE)
    grouped = readings.groupBy(*keys[:1], *extra_keys, day, *keys[1:])
    return grouped.agg(_mean(v, null_policy).alias(VALUE))


def daily_mean_first(rows: DataFrame, keys, time_col: str, order_cols,
                     value_col: str = VALUE, payload=None) -> DataFrame:
    """Daily mean of `value_col` (missing values skipped) per keys and civil
    day; every other column is taken from the day's first row by `order_cols`.

    The first row is found with min_by over a struct, a two-phase aggregate
    (no window, no per-group collection)."""
    keys = list(keys)
    order_cols = list(order_cols)
    if payload is None:
        payload = [c for c in rows.columns if c not in {*keys, time_col, value_col}]
    agg = [F.avg(clean_value(value_col)).alias(value_col)]
    if payload:
        first = F.min_by(F.struct(*payload), F.struct(*order_cols))
        agg.append(first.alias("__first"))
    out = rows.groupBy(*keys, civil_day(time_col).alias(DATE)).agg(*agg)
    if payload:
        out = out.select(*keys, DATE, value_col, "__first.*")
    return out


def min_date(*frames: DataFrame, col: str = DATE) -> DataFrame:
    """One row, one column `min_date`: the earliest day over all frames
    (NULL when they are all empty)."""
    dates = reduce(DataFrame.unionAll, [f.select(F.col(col).alias("min_date")) for f in frames])
    return dates.agg(F.min("min_date").alias("min_date"))
