"""Reads of the published archive and of the stored tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, FLOW, LEVEL, PARAMETER, PROVINCE, PUB_STATUS, PUBLISHED, STATION


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A whole stored table (Parquet)."""
    return spark.read.parquet(path)


def in_province(df: DataFrame, stations: DataFrame, province: str) -> DataFrame:
    """Rows of `df` whose station lies in `province`: a semi-join against
    the station table (AQE broadcasts it when its measured size is small)."""
    s = stations.filter(F.col(PROVINCE) == F.lit(province)).select(STATION)
    return df.join(s, STATION, "left_semi")


def published_daily(daily: DataFrame, stations: DataFrame, province: str,
                    parameters=(FLOW, LEVEL)) -> DataFrame:
    """Published daily values of one province, marked Published."""
    d = daily.filter(F.col(PARAMETER).isin(list(parameters)))
    return in_province(d, stations, province).withColumn(PUB_STATUS, F.lit(PUBLISHED))


def station_metadata(stations: DataFrame, province: str) -> DataFrame:
    """Station rows of one province."""
    return stations.filter(F.col(PROVINCE) == F.lit(province))


def realtime_readings(readings: DataFrame, stations: DataFrame, province: str) -> DataFrame:
    """Readings of one province."""
    return in_province(readings, stations, province)


def stored_since(stored: DataFrame, since, include_null_days: bool = False) -> DataFrame:
    """Stored rows on or after a day. `since` may be a date, a string, a
    Column or a one-row DataFrame (used as a scalar subquery, so the bound
    stays inside one plan and still reaches the Parquet scan). When the table
    carries a `year` partition column the bound prunes partitions too.
    `include_null_days` also keeps rows without a day (for J1, so that a
    rerun finds them stored)."""
    if isinstance(since, DataFrame):
        bound: Column = since.scalar()
    elif isinstance(since, Column):
        bound = since
    else:
        bound = F.lit(since if isinstance(since, _dt.date) else _dt.date.fromisoformat(str(since)))
    keep = F.col(DATE) >= bound
    if include_null_days:
        keep = keep | F.col(DATE).isNull()
    out = stored.filter(keep)
    if "year" in stored.columns:
        y = F.col("year") >= F.year(bound)
        out = out.filter(y | F.col("year").isNull() if include_null_days else y)
    return out
