"""Has a new archive release appeared? A release counts as new when its
stamp differs from the stored one (not only when it is later)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugekeep.functions.scalars import release_stamp, yyyymmdd


def release_stamps(listing: DataFrame, text_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """F5 per listing page: page id and the stamp after the last marker."""
    return listing.select(id_col, release_stamp(text_col).alias("release_stamp"))


def stored_stamp(pub_status: DataFrame) -> Column:
    """yyyyMMdd of the stored publication time, as a scalar subquery."""
    return pub_status.select(yyyymmdd("pub_dttm").alias("s")).scalar()


def release_changed(listing: DataFrame, stored, text_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """All pages, with the stored stamp and whether theirs differs: true if
    nothing is stored yet, null for a page without a stamp.
    `stored` is a 'yyyyMMdd' string or a Column (e.g. stored_stamp(...))."""
    s = F.lit(stored) if isinstance(stored, str) else stored
    st = release_stamps(listing, text_col, id_col)
    return st.select(id_col, "release_stamp", s.alias("stored_stamp"),
                     F.when(F.col("release_stamp").isNotNull(), ~F.col("release_stamp").eqNullSafe(s)).alias("changed"))
