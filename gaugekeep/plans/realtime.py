"""Realtime update. Daily means of the newest readings (A2), split into
flow and level (P2), optionally merged with scraped masters (W1), reduced to
station-days not stored yet (A3, S5, J1) and appended (K2).

A stored day is never changed here; any day not stored yet is added, however
old. Running it twice with the same input adds nothing the second time."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, FLOW, LEVEL, PARAMETER, PUB_STATUS, STATION, UNPUBLISHED, VALUE
from gaugekeep.operators.daily import min_date, realtime_daily_mean
from gaugekeep.operators.merge import new_rows, prefer_first
from gaugekeep.session import ensure_checkpoint_dir
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources.archive import stored_since

UPDATE_COLUMNS = (STATION, DATE, PARAMETER, VALUE)
TABLE = "__table"  # which stored table a candidate row belongs to


def split_parameter(daily: DataFrame, parameter: str) -> DataFrame:
    """P2 + P3 + P5: one parameter's rows, four columns, marked Unpublished."""
    return (daily.filter(F.col(PARAMETER) == F.lit(parameter)).select(*UPDATE_COLUMNS)
            .withColumn(PUB_STATUS, F.lit(UNPUBLISHED)))


def _scraped(scraped: DataFrame, parameter: str, scraped_order=()) -> DataFrame:
    keep = [c for c in scraped_order if c in scraped.columns]
    return (scraped.select(STATION, DATE, F.lit(parameter).alias(PARAMETER), VALUE, *keep)
            .withColumn(PUB_STATUS, F.lit(UNPUBLISHED)))


def _sources(daily: DataFrame, scraped_flow: DataFrame | None, scraped_level: DataFrame | None,
             scraped_order=()) -> list[DataFrame]:
    """Candidate sources in priority order (scraped first), each holding flow
    and level rows tagged with their table."""
    rt = (daily.filter(F.col(PARAMETER).isin(FLOW, LEVEL)).select(*UPDATE_COLUMNS)
          .withColumn(PUB_STATUS, F.lit(UNPUBLISHED)).withColumn(TABLE, F.col(PARAMETER)))
    scraped = [_scraped(s, p, scraped_order).withColumn(TABLE, F.lit(p))
               for s, p in ((scraped_flow, FLOW), (scraped_level, LEVEL)) if s is not None]
    if not scraped:
        return [rt]
    sc = scraped[0] if len(scraped) == 1 else scraped[0].unionByName(scraped[1])
    return [sc, rt]


def _merge(sources: list[DataFrame], scraped_order=()) -> DataFrame:
    """W1 over both tables at once: one row per (station, day, table)."""
    return sources[0] if len(sources) == 1 else prefer_first(sources, (STATION, DATE, TABLE), scraped_order)


def updates(daily: DataFrame, scraped_flow: DataFrame | None = None, scraped_level: DataFrame | None = None,
            scraped_order=()) -> tuple[DataFrame, DataFrame]:
    """Candidate rows per table; scraped rows win over realtime rows of the
    same station-day."""
    both = _merge(_sources(daily, scraped_flow, scraped_level, scraped_order), scraped_order)
    both = both.drop(*[c for c in scraped_order if c in both.columns])
    return (both.filter(F.col(TABLE) == FLOW).drop(TABLE),
            both.filter(F.col(TABLE) == LEVEL).drop(TABLE))


def _stored_tagged(stored_flow: DataFrame, stored_level: DataFrame, since: DataFrame) -> DataFrame:
    keys = [STATION, DATE]
    # stored rows without a day stay in the comparison (D17), so that a rerun
    # never appends a day-less row twice
    f = stored_since(stored_flow, since, include_null_days=True).select(*keys, F.lit(FLOW).alias(TABLE))
    lv = stored_since(stored_level, since, include_null_days=True).select(*keys, F.lit(LEVEL).alias(TABLE))
    return f.unionAll(lv)


def realtime_update_rows(daily: DataFrame, stored_flow: DataFrame, stored_level: DataFrame,
                         scraped_flow: DataFrame | None = None, scraped_level: DataFrame | None = None,
                         skip_null_days: bool = False, complete_before: _dt.date | None = None,
                         scraped_order=()) -> DataFrame:
    """New rows of both tables in one plan, tagged with `__table`.

    One aggregation of the daily means, one window for the scraped merge,
    one null-safe anti-join against both stored tables (read from the
    earliest update day on; the bound is a scalar subquery that reaches the
    scans). Equivalent to one anti-join per table on (station, day).
    `scraped_order`: columns of the scraped inputs that order rows within
    them (e.g. from read_master_csv(order_col=...)); the earlier row wins."""
    if skip_null_days:
        daily = daily.filter(F.col(VALUE).isNotNull())
    if complete_before is not None:
        daily = daily.filter(F.col(DATE) < F.lit(complete_before))
    src = _sources(daily, scraped_flow, scraped_level, scraped_order)
    # the merge keeps every (station, day) key, so the earliest day is taken
    # from the sources directly and the subquery needs no window
    since = min_date(*src)
    merged = _merge(src, scraped_order)
    merged = merged.drop(*[c for c in scraped_order if c in merged.columns])
    return new_rows(merged, _stored_tagged(stored_flow, stored_level, since), (STATION, DATE, TABLE))


def realtime_update(daily: DataFrame, stored_flow: DataFrame, stored_level: DataFrame,
                    scraped_flow: DataFrame | None = None, scraped_level: DataFrame | None = None,
                    skip_null_days: bool = False, complete_before: _dt.date | None = None,
                    scraped_order=()) -> tuple[DataFrame, DataFrame]:
    """New rows for the flow and level tables (two views of one plan)."""
    rows = realtime_update_rows(daily, stored_flow, stored_level, scraped_flow, scraped_level,
                                skip_null_days, complete_before, scraped_order)
    return (rows.filter(F.col(TABLE) == FLOW).drop(TABLE),
            rows.filter(F.col(TABLE) == LEVEL).drop(TABLE))


def realtime_update_from_readings(readings: DataFrame, stored_flow: DataFrame, stored_level: DataFrame,
                                  time_col: str = DATE, null_policy: str = "skip", **kw):
    daily = realtime_daily_mean(readings, time_col=time_col, null_policy=null_policy)
    return realtime_update(daily, stored_flow, stored_level, **kw)


def run_realtime_update(store: TableStore, daily: DataFrame, **kw) -> dict[str, int]:
    """Adds the new rows to flow and level in one commit.

    The new rows are computed once and checkpointed to the cluster's shared
    checkpoint folder (`spark.checkpoint.dir`); both appends read that copy,
    so the readings are not aggregated twice and a lost executor does not
    force a recomputation from the raw input. Both tables are read at one
    snapshot, and the commit fails (CommitConflict) if another came after it, so
    rows that two jobs found new are added once. Tables that don't exist are made."""
    ensure_checkpoint_dir(store.spark)
    base = store.snapshot()

    def stored(table: str) -> DataFrame:
        return base.read(table, keep_year=True) if table in base.tables else \
            store.spark.createDataFrame([], f"{STATION} string, {DATE} date")

    rows = realtime_update_rows(daily, stored("flow"), stored("level"), **kw).checkpoint(eager=True)
    found = {r[TABLE]: r["count"] for r in rows.groupBy(TABLE).count().collect()}
    with store.transaction(base) as t:
        for table, label in (("flow", FLOW), ("level", LEVEL)):
            if label in found or table not in base.tables:
                t.append(table, rows.filter(F.col(TABLE) == label).drop(TABLE))
    return {"flow": found.get(FLOW, 0), "level": found.get(LEVEL, 0)}
