"""Freshness report: last publication, last update, days ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.functions.scalars import days_between


def freshness(publications: DataFrame, pub_col: str, updates: DataFrame, upd_col: str) -> DataFrame:
    """One row: last_publication = max(pub_col), last_update = max(upd_col),
    days_ahead = their difference in days, 2 decimals (half to even).
    Both maxima are scalar subqueries of one plan; no clock is read."""
    pub = publications.agg(F.max(pub_col)).scalar()
    upd = updates.agg(F.max(upd_col).cast("timestamp_ntz").alias("last_update"))
    return upd.select(pub.cast("timestamp_ntz").alias("last_publication"), "last_update",
                      days_between(F.col("last_update"), pub).alias("days_ahead"))


def freshness_report(fresh: DataFrame) -> DataFrame:
    """K5 text of the freshness row, one column `report`."""
    text = F.concat_ws("\n",
                       F.lit("Daily table update status"),
                       F.lit(""),
                       F.concat(F.lit("Last archive publication: "), F.col("last_publication").cast("string")),
                       F.concat(F.lit("Last realtime update: "), F.col("last_update").cast("string")),
                       F.lit(""),
                       F.concat(F.lit("Stored data run ahead of the publication by "),
                                F.col("days_ahead").cast("string"), F.lit(" days")))
    return fresh.select(text.alias("report"))
