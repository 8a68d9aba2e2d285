"""Download manifest: one row per station to fetch, with the date
window and the request URL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import REALTIME_REPORT_QUERY, REALTIME_REPORT_URL, STATION
from gaugekeep.functions.scalars import window_start
from gaugekeep.plans.station_report import stations_to_fetch


def download_manifest(stations: DataFrame, as_of: _dt.date, months: float = 18, sample: int | None = None,
                      seed: int = 0, base_url: str = REALTIME_REPORT_URL) -> DataFrame:
    """`as_of` is the run day (passed in, never read from the clock)."""
    end = F.lit(as_of)
    start = window_start(end, months)
    prefix, suffix = REALTIME_REPORT_QUERY.split("{start}")
    mid, tail = suffix.split("{end}")
    url = F.concat(F.lit(base_url + "?stn="), F.col(STATION), F.lit(prefix), start.cast("string"),
                   F.lit(mid), end.cast("string"), F.lit(tail))
    return (stations_to_fetch(stations, sample, seed)
            .select(STATION, start.alias("start_date"), end.alias("end_date"), url.alias("url"))
            .orderBy(STATION))
