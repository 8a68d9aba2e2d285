"""The update job as one call: release check (C6), integration of a new
publication (C2) only when its stamp differs from the stored one, publication
status row (F8), realtime update (C3), freshness report (C8).

Tables, station metadata and status row of a publication become visible in one
commit; the rows of the realtime update in a second one. So a job that fails in
between either integrates the publication again or finds it integrated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DATE
from gaugekeep.functions.scalars import path_basename, yyyymmdd
from gaugekeep.operators.daily import realtime_daily_mean
from gaugekeep.plans.freshness import freshness, freshness_report
from gaugekeep.plans.integrate import run_integrate
from gaugekeep.plans.realtime import run_realtime_update
from gaugekeep.plans.release import release_stamps
from gaugekeep.sinks.files import write_report
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources.archive import published_daily, realtime_readings, station_metadata

STATUS_TABLE = "pub_status"


def pub_status_rows(releases: DataFrame, path_col: str = "path", stamp_col: str = "release_stamp") -> DataFrame:
    """filename, path, pub_dttm, pub_date of every release (path, yyyyMMdd
    stamp); times are null where the stamp is no date."""
    at = F.try_to_timestamp(F.col(stamp_col), F.lit("yyyyMMdd"))
    return releases.select(path_basename(path_col).alias("filename"), F.col(path_col).alias("path"),
                           at.cast("timestamp_ntz").alias("pub_dttm"), at.cast("date").alias("pub_date"))


def run_update(store: TableStore, listing: DataFrame, archive_path: str, publication: DataFrame, readings: DataFrame,
               stations: DataFrame, province: str, report_path: str | None = None, time_col: str = DATE, **kw) -> dict:
    """`listing`: the release pages (page_id, html), of which the newest stamp
    counts; `publication` and `readings` are limited to the stations of
    `province` and read only as far as needed. Returns whether a publication
    was integrated and the rows appended per table; `kw` goes to C3."""
    spark = store.spark
    stamp = release_stamps(listing).agg(F.max("release_stamp").alias("s")).first().s
    known = store.read(STATUS_TABLE).agg(F.max(yyyymmdd("pub_dttm")).alias("s")).first().s \
        if store.exists(STATUS_TABLE) else None
    changed = stamp is not None and stamp != known
    if changed:
        release = spark.createDataFrame([(archive_path, stamp)], "path string, release_stamp string")
        run_integrate(store, published_daily(publication, stations, province), station_metadata(stations, province),
                      also={STATUS_TABLE: pub_status_rows(release)})
    daily = realtime_daily_mean(realtime_readings(readings, stations, province), time_col=time_col)
    counts = run_realtime_update(store, daily, **kw)
    if report_path and store.exists(STATUS_TABLE):
        days = store.read("flow").select(DATE).unionAll(store.read("level").select(DATE))
        write_report(freshness_report(freshness(store.read(STATUS_TABLE), "pub_dttm", days, DATE)), report_path)
    return {"integrated": changed, **counts}
