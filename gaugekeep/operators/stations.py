"""Station selection: active stations (P1), seeded sample (L1), order (L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DISCONTINUED, STATION, STATUS


def active_stations(stations: DataFrame) -> DataFrame:
    """Stations not discontinued. A NULL status is dropped as well (SQL
    comparison with NULL is not true)."""
    return stations.filter(F.col(STATUS) != F.lit(DISCONTINUED))


def sample_stations(stations: DataFrame, n: int | None = None, seed: int = 0) -> DataFrame:
    """n stations without replacement, capped at the table size; None keeps
    all. Seeded by the md5 of seed and station id, so reruns pick the same set; the
    limit runs as a per-partition top-n, never a full sort on one task."""
    if n is None:
        return stations
    return stations.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(STATION)).cast("binary")), F.col(STATION)).limit(int(n))


def station_order(stations: DataFrame) -> DataFrame:
    return stations.orderBy(STATION)
