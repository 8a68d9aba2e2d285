"""

``entry(spark)`` runs the flagship job (the realtime update, C3) on sf0.001.
(spark, sf_dir); the inputs are the stand-in views of FIXTURES.md built from
the driver's tables (``gaugekeep.sources.stand_ins``).
``oracle_sql()`` gives, per query, DuckDB SQL over the same tables, written
independently of the Spark code from the same mapping.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.columns import DAY_KEYS, FLOW, GRADE, LEVEL, PARAMETER, PROVINCE, RELEASE_MARKER, STATION, VALUE
from gaugekeep.functions.columns import flatten_point, resolve_columns
from gaugekeep.functions.names import parameter_label, variable_name
from gaugekeep.functions.scalars import is_leap_year
from gaugekeep.operators.daily import daily_mean_first, min_date, realtime_daily_mean
from gaugekeep.operators.merge import anti_join_in_place, new_rows, stack, unaffected_rows
from gaugekeep.operators.reports import coverage, empty_stations, empty_views, extraction_summary
from gaugekeep.operators.stations import active_stations, sample_stations, station_order
from gaugekeep.session import apply_conf, scratch_dir
from gaugekeep.plans.archive_check import empty_archive_tables, missing_archive_tables
from gaugekeep.plans.freshness import freshness
from gaugekeep.plans.integrate import integrate_publication, run_integrate
from gaugekeep.plans.manifest import download_manifest
from gaugekeep.plans.masters import masters_from_folder, write_masters
from gaugekeep.plans.realtime import realtime_update_rows, run_realtime_update, split_parameter, updates
from gaugekeep.plans.release import release_changed, release_stamps, stored_stamp
from gaugekeep.plans.reset import TABLES, reset_tables, run_reset
from gaugekeep.plans.station_report import report_of_stats, station_report, stations_to_fetch
from gaugekeep.plans.update import pub_status_rows
from gaugekeep.sinks.files import write_csv
from gaugekeep.sinks.history import buckets_for, write_history
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources import stand_ins as si
from gaugekeep.sources.archive import published_daily, station_metadata, stored_since
from gaugekeep.sources.csvfiles import read_master_csv, read_pub_status
from gaugekeep.sources.filetable import FILES, list_raw_files, refresh_file_table
from gaugekeep.sources.rawfiles import raw_file_stats, raw_file_table, raw_readings
from gaugekeep.sources.rawlines import read_raw_lines
from gaugekeep.sources.smallfiles import Listed, read_listed_lines
from gaugekeep.streaming.realtime_stream import realtime_stream

try:  # the training-data operators are an addition: without them the rest works
    import corpus_pipeline
    from gaugekeep.llm import registry as llm
except ImportError:
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
PROVINCE_ASKED = "BC"
SINCE = _dt.date(2024, 1, 10)
AS_OF = _dt.date(2024, 1, 31)
MONTHS = 18
SAMPLE_N, SAMPLE_SEED = 100, 42
LOGGED_ISSUE = "Archive could not be unpacked"
STORED_STAMP = "20240115"
EMPTIED_EVERY = 5
HEADLESS_EVERY = 4
STREAM_FILES, FILES_A_BATCH = 6, 2
DAILY_DIGITS = 4
# Large raw files: all readings in the files of so many stations, read in about so many splits.
LARGE_FILE_STATIONS, SPLITS = 8, 200
# Tables the stand-in archive is expected to hold: the driver's tables plus a
# release `version` table that it does not ship.
EXPECTED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                   "documents", "embeddings", "pages", "benchmark", "labels", "conversations", "version"]
# Heading variants per parameter, to exercise every naming rule on data.
HEADING_VARIANTS = [
    ("Flow", "Discharge"), ("Flow", "Discharge (daily)"), ("Flow", "Flow"),
    ("Level", "Water level (unit values)"), ("Level", "Water Level (Primary Sensor)"),
    ("Level", "Water Level (Secondary Sensor)"), ("Level", "Level"),
    ("Water Temperature", "Water temperature"), ("Water Temperature", "Temperature"),
    ("Precipitation", "Precipitation"), ("Precipitation", "Precip Total"),
    ("Air Temperature", "Air temperature"), ("Air Temperature", "Air Temp"),
]

# ---------------------------------------------------------------- helpers


def _r4(df: DataFrame) -> DataFrame:
    return df.withColumn(VALUE, F.round(VALUE, DAILY_DIGITS))


def _stations(spark, d):
    return si.stations(spark, d)


def _flat(df: DataFrame) -> DataFrame:
    return df.drop("geometry")


def _rt_split(spark, d, param):
    return split_parameter(si.realtime(spark, d), param)


def _stored(spark, d, param):
    return si.published(spark, d).filter(F.col(PARAMETER) == param)


def _new(spark, d, param):
    flow, level = _rt_split(spark, d, FLOW), _rt_split(spark, d, LEVEL)
    since = min_date(flow, level)
    inc = flow if param == FLOW else level
    return new_rows(inc, stored_since(_stored(spark, d, param), since))


def _new_rows_in_place(spark, d):
    """J1 against stored history that is bucketed by station and day."""
    stored = _stored(spark, d, FLOW)
    history = write_history(stored, f"history_{uuid.uuid4().hex}", scratch_dir(spark, "history"), buckets_for(stored.count()))
    return anti_join_in_place(_rt_split(spark, d, FLOW), history, DAY_KEYS)


def _scraped_first(spark, d, param):
    sc = si.scraped(spark, d)
    flow, level = updates(si.realtime(spark, d), sc.filter(F.col(PARAMETER) == FLOW),
                          sc.filter(F.col(PARAMETER) == LEVEL))
    return flow if param == FLOW else level


def _realtime_update(spark, d):
    sc = si.scraped(spark, d)
    rows = realtime_update_rows(si.realtime(spark, d), _stored(spark, d, FLOW), _stored(spark, d, LEVEL),
                                scraped_flow=sc.filter(F.col(PARAMETER) == FLOW),
                                scraped_level=sc.filter(F.col(PARAMETER) == LEVEL))
    return rows.drop("__table")


def _append_new(spark, d):
    stored = _stored(spark, d, FLOW)
    return stack(stored, _new(spark, d, FLOW))


def _both(store):
    return stack(store.read("flow"), store.read("level"))


def _integrate_store(spark, d):
    """C2 on stored tables: the realtime rows are stored, the publication is
    folded in by year, and the tables are read back."""
    store = TableStore(spark, scratch_dir(spark, "store"))
    with store.transaction() as t:
        for table, param in TABLES.items():
            t.replace(table, si.realtime(spark, d).filter(F.col(PARAMETER) == param))
    run_integrate(store, si.published(spark, d))
    return _both(store)


def _append_store(spark, d):
    """C1 and C3 on stored tables: reset from the publication, realtime rows
    appended to both tables by one commit, and read back."""
    store = TableStore(spark, scratch_dir(spark, "store"))
    run_reset(store, si.published(spark, d))
    run_realtime_update(store, si.realtime(spark, d).drop("pub_status", "user_id"))
    return _both(store)


def _release_gate(spark, d):
    """C6 against the stored status row (S7): the earliest listed release is the
    one stored, as CSV; the stamp is read back from it."""
    listed = release_stamps(si.listing(spark, d))
    first = listed.agg(F.min("release_stamp").alias("release_stamp")).withColumn("path", F.lit("archive/first.zip"))
    path = scratch_dir(spark, "pub-status")
    write_csv(pub_status_rows(first), path)
    return release_changed(si.listing(spark, d), stored_stamp(read_pub_status(spark, path)))


def _masters_of(spark, root):
    return masters_from_folder(spark, root, si.raw_pattern(root), si.raw_name)


def _masters_csv_roundtrip(spark, d):
    """C4 to CSV (K3) and back (S4) into C3, where the scraped rows win."""
    out = scratch_dir(spark, "masters")
    write_masters(_masters_of(spark, _on_disk(spark, d)), out, csv=True)
    flow = read_master_csv(spark, f"{out}/variable=flow", order_col="__order")
    level = read_master_csv(spark, f"{out}/variable=water_level (unit values)", order_col="__order")
    rows = realtime_update_rows(si.realtime(spark, d), _stored(spark, d, FLOW), _stored(spark, d, LEVEL),
                                scraped_flow=flow, scraped_level=level, scraped_order=["__order"])
    return _r4(rows.drop("__table"))


def _variants(spark, d):
    files = si.readings(spark, d).select(STATION, PARAMETER).distinct()
    h = spark.createDataFrame(HEADING_VARIANTS, f"{PARAMETER} string, heading string")
    return files.join(h, PARAMETER).select(STATION, F.concat("heading", F.lit(".csv")).alias("file_name"))


def _variable_name(spark, d):
    return _variants(spark, d).withColumn("variable", variable_name("file_name"))


def _parameter_label(spark, d):
    return _variable_name(spark, d).withColumn(PARAMETER, parameter_label("variable"))


def _resolve(spark, d):
    r = si.readings(spark, d).select(
        STATION, "event_id", F.col("ts").alias("Date (PST)"), PARAMETER,
        F.col(VALUE).alias("Value (m3/s)"), F.col(GRADE).alias("Grade"))
    return resolve_columns(r)


def _daily_first(spark, d):
    out = daily_mean_first(si.readings(spark, d), keys=[STATION, PARAMETER], time_col="ts",
                           order_cols=["ts", "event_id"], payload=[GRADE, "event_id", "user_id"])
    return _r4(out)


def _raw_stats(spark, d, emptied=None):
    return raw_file_stats(raw_file_table(si.raw_files(spark, d, emptied)))


_WRITTEN: dict[tuple, str] = {}


def _on_disk(spark, d, **kw):
    """Station files written to a folder beside the checkpoints, once a session."""
    key = (spark.sparkContext.applicationId, d, *sorted(kw.items()))
    if key not in _WRITTEN:
        root = scratch_dir(spark, "raw-files")
        si.write_raw_files(spark, d, root, flat="stations" not in kw, **kw)
        _WRITTEN[key] = root
    return _WRITTEN[key]


def _raw_file_parse(spark, d):
    root = _on_disk(spark, d)
    files = list_raw_files(spark, root, si.raw_pattern(root))
    return raw_readings(read_listed_lines(spark, Listed(files), si.raw_name))


def _raw_lines_split(spark, d):
    """Few large files, cut into splits of a fraction of a file (a session of its
    own holds the split size, so that no other query gets it)."""
    root = _on_disk(spark, d, stations=LARGE_FILE_STATIONS)
    own = spark.newSession()
    apply_conf(own)
    size = own.read.format("binaryFile").load(si.raw_paths(root)).agg(F.sum("length").alias("n")).first().n or 0
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(64, size // SPLITS)))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return raw_readings(read_raw_lines(own, si.raw_paths(root), si.raw_name))


def _masters(spark, d):
    return _r4(_masters_of(spark, _on_disk(spark, d)))


def _masters_newest_file(spark, d):
    """D6 by the listing: every station has an older file of each variable (a
    heading that sorts before the other) with readings that must not count."""
    root = _on_disk(spark, d, older=True)
    return _r4(_masters_of(spark, root))


def _report(spark, d, key):
    return station_report(_stations(spark, d), si.raw_files(spark, d, EMPTIED_EVERY))[key]


def _file_stats(spark, d):
    """C5/A4 with the stored file table: the first run sees the flow files only, the
    second parses the others; the rows are read back."""
    root = _on_disk(spark, d, emptied_every=EMPTIED_EVERY, headless_every=HEADLESS_EVERY)
    store = TableStore(spark, scratch_dir(spark, "store"))
    refresh_file_table(store, root, si.raw_pattern(root, "Discharge"), si.raw_name)
    refresh_file_table(store, root, si.raw_pattern(root), si.raw_name)
    return store.read(FILES).drop("path", "size", "modified")


def _station_issues(spark, d):
    """U2 with all its branches: no files, only empty files, a file without a header
    that can be read, and issues of a download log (of the stations of AB)."""
    stations = _stations(spark, d)
    log = stations.filter(F.col(PROVINCE) == "AB").select(F.col(STATION).alias("station_id"), F.lit(LOGGED_ISSUE).alias("issue"))
    return report_of_stats(stations_to_fetch(stations), _file_stats(spark, d), log)["problem_stations"]


def _masters_whole_stations(spark, d):
    """C4 where some stations have a file that cannot be read: they get no rows."""
    root = _on_disk(spark, d, emptied_every=EMPTIED_EVERY, headless_every=HEADLESS_EVERY)
    return _r4(_masters_of(spark, root))


def _stream_update(spark, d):
    """The readings come in files that each hold a part of every day, some files
    a micro-batch; flow and level are read back."""
    feed, store = scratch_dir(spark, "feed"), TableStore(spark, scratch_dir(spark, "store"))
    run_reset(store, si.published(spark, d).drop("user_id"))
    readings = si.readings(spark, d).select(STATION, "ts", PARAMETER, VALUE)
    readings.repartition(STREAM_FILES, F.xxhash64("ts")).write.parquet(feed)
    q = realtime_stream(spark, feed, readings.schema, store, scratch_dir(spark, "stream"), time_col="ts",
                        max_files_per_trigger=FILES_A_BATCH)
    q.awaitTermination()
    return _r4(_both(store))


def _coverage(spark, d):
    asked = active_stations(_stations(spark, d))
    stats = _raw_stats(spark, d)
    return coverage(asked, extraction_summary(stats, asked))


def _leap(spark, d):
    years = spark.read.parquet(f"{d}/orders.parquet").select(F.year("o_orderdate").cast("int").alias("year"))
    fixed = spark.createDataFrame([(1900,), (2000,), (2100,)], "year int")
    return years.unionByName(fixed).distinct().withColumn("is_leap", is_leap_year("year"))


def _pub_status(spark, d):
    """The status row that every listed release would get (F8)."""
    path = F.concat(F.lit(f"archive/{RELEASE_MARKER}"), F.col("release_stamp"), F.lit(".zip"))
    return pub_status_rows(release_stamps(si.listing(spark, d)).withColumn("path", path))


def _empty_views(spark, d):
    """L3 with a view that holds no row (no day lies that late)."""
    return empty_views(spark, {"published": si.published(spark, d),
                               "stored_none": stored_since(si.daily(spark, d), "3000-01-01")})


def _freshness(spark, d):
    return freshness(spark.read.parquet(f"{d}/orders.parquet"), "o_orderdate",
                     spark.read.parquet(f"{d}/events.parquet"), "ts")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the realtime update (C3) with scraped data, on sf0.001."""
    return _realtime_update(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources
        "published_daily": lambda s, d: published_daily(si.daily(s, d), _stations(s, d), PROVINCE_ASKED),
        "split_flow": lambda s, d: split_parameter(
            published_daily(si.daily(s, d), _stations(s, d), PROVINCE_ASKED), FLOW),
        "split_level": lambda s, d: split_parameter(
            published_daily(si.daily(s, d), _stations(s, d), PROVINCE_ASKED), LEVEL),
        "station_metadata": lambda s, d: _flat(station_metadata(_stations(s, d), PROVINCE_ASKED)),
        "active_stations": lambda s, d: _flat(station_order(active_stations(_stations(s, d)))),
        "station_lonlat": lambda s, d: flatten_point(_stations(s, d)),
        "raw_file_parse": _raw_file_parse,
        "raw_lines_split": _raw_lines_split,
        "stored_since": lambda s, d: stored_since(si.daily(s, d), SINCE),
        # sinks / merges
        "append_new": _append_new,
        "append_store": _append_store,
        "integrate_store": _integrate_store,
        "release_gate": _release_gate,
        "masters_csv_roundtrip": _masters_csv_roundtrip,
        "realtime_update": _realtime_update,
        "resolve_columns": _resolve,
        "parameter_label": _parameter_label,
        "variable_name": _variable_name,
        "new_flow_rows": lambda s, d: _new(s, d, FLOW),
        "new_flow_rows_in_place": _new_rows_in_place,
        "new_level_rows": lambda s, d: _new(s, d, LEVEL),
        "unaffected_rows": lambda s, d: unaffected_rows(si.realtime(s, d), si.published(s, d)),
        "union_published_unpublished": lambda s, d: stack(
            si.published(s, d), si.realtime(s, d).drop("user_id")),
        "integrate_publication": lambda s, d: integrate_publication(si.published(s, d), si.realtime(s, d)),
        "reset_tables": lambda s, d: reset_tables(si.daily(s, d)),
        # aggregates
        "daily_mean_first": _daily_first,
        "realtime_daily_mean": lambda s, d: _r4(realtime_daily_mean(si.readings(s, d), time_col="ts")),
        "realtime_daily_mean_poison": lambda s, d: _r4(
            realtime_daily_mean(si.readings(s, d), time_col="ts", null_policy="poison")),
        "min_update_date": lambda s, d: min_date(*(split_parameter(si.daily(s, d), p) for p in (FLOW, LEVEL))),
        "empty_stations": lambda s, d: empty_stations(_raw_stats(s, d, EMPTIED_EVERY)),
        "problem_stations": lambda s, d: _report(s, d, "problem_stations"),
        "extraction_summary": lambda s, d: extraction_summary(_raw_stats(s, d)),
        "coverage_pct": _coverage,
        # windows, samples, sets
        "scraped_first_flow": lambda s, d: _scraped_first(s, d, FLOW),
        "scraped_first_level": lambda s, d: _scraped_first(s, d, LEVEL),
        "sample_stations": lambda s, d: _flat(station_order(
            sample_stations(active_stations(_stations(s, d)), SAMPLE_N, SAMPLE_SEED))),
        "missing_tables": lambda s, d: missing_archive_tables(s, d, EXPECTED_TABLES),
        "empty_tables": lambda s, d: empty_archive_tables(s, d),
        # composite jobs
        "masters": _masters,
        "masters_newest_file": _masters_newest_file,
        "masters_whole_stations": _masters_whole_stations,
        "file_stats": _file_stats,
        "station_issues": _station_issues,
        "stream_update": _stream_update,
        "release_stamp": lambda s, d: release_stamps(si.listing(s, d)),
        "pub_status_row": _pub_status,
        "empty_views": _empty_views,
        "release_changed": lambda s, d: release_changed(si.listing(s, d), STORED_STAMP),
        "freshness": _freshness,
        "download_manifest": lambda s, d: download_manifest(_stations(s, d), AS_OF, MONTHS),
        "is_leap_year": _leap,
    }


# ------------------------------------------------------------------ oracle

_VIEWS = """
readings AS (
  SELECT '08' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS STATION_NUMBER, ts, CAST(ts AS DATE) AS d,
         CASE event_type WHEN 'view' THEN 'Flow' WHEN 'click' THEN 'Level'
              WHEN 'signup' THEN 'Water Temperature' WHEN 'error' THEN 'Precipitation'
              ELSE 'Air Temperature' END AS Parameter,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS Value,
         props AS Grade, event_id, user_id
  FROM events),
daily AS (
  SELECT STATION_NUMBER, user_id, d AS "Date", Parameter, round(avg(Value), 4) AS Value
  FROM readings GROUP BY STATION_NUMBER, user_id, d, Parameter),
published AS (
  SELECT STATION_NUMBER, "Date", Parameter, Value, 'Published' AS pub_status, user_id FROM daily
  WHERE "Date" < DATE '2024-01-16' AND user_id % 7 <> 0 AND Parameter IN ('Flow', 'Level')),
realtime AS (
  SELECT STATION_NUMBER, "Date", Parameter, Value, 'Unpublished' AS pub_status, user_id FROM daily
  WHERE "Date" >= DATE '2024-01-10' AND Parameter IN ('Flow', 'Level')),
scraped AS (
  SELECT STATION_NUMBER, "Date", Parameter, Value + 1000 AS Value, 'Unpublished' AS pub_status, user_id
  FROM daily
  WHERE "Date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND user_id % 3 = 0
    AND Parameter IN ('Flow', 'Level')),
stations AS (
  SELECT '08' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS STATION_NUMBER,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'DISCONTINUED' WHEN 'HOUSEHOLD' THEN NULL
              ELSE 'ACTIVE' END AS STATION_OPERATING_STATUS,
         CASE WHEN c_nationkey < 12 THEN 'BC' ELSE 'AB' END AS PROV_TERR_STATE_LOC, c_custkey
  FROM customer),
listing AS (
  SELECT page_id, html || CASE WHEN page_id % 2 = 0
    THEN ' Hydat_sqlite3_20200101.zip Hydat_sqlite3_2024' || lpad(CAST(1 + page_id % 12 AS VARCHAR), 2, '0') || '15.zip'
    ELSE '' END AS html
  FROM pages),
headings AS (
  SELECT * FROM (VALUES ('Flow', 'Discharge'), ('Level', 'Water level (unit values)'),
    ('Water Temperature', 'Water temperature'), ('Precipitation', 'Precipitation'),
    ('Air Temperature', 'Air temperature')) t(Parameter, heading)),
files AS (
  SELECT DISTINCT r.STATION_NUMBER, r.user_id, r.Parameter, h.heading, h.heading || '.csv' AS file_name
  FROM readings r JOIN headings h ON r.Parameter = h.Parameter),
active AS (
  SELECT STATION_NUMBER, STATION_OPERATING_STATUS, PROV_TERR_STATE_LOC FROM stations
  WHERE STATION_OPERATING_STATUS <> 'DISCONTINUED'),
rt_flow AS (SELECT STATION_NUMBER, "Date", Parameter, Value, pub_status FROM realtime WHERE Parameter = 'Flow'),
rt_level AS (SELECT STATION_NUMBER, "Date", Parameter, Value, pub_status FROM realtime WHERE Parameter = 'Level'),
rt_min AS (SELECT min("Date") AS m FROM realtime)
"""


def _variable_sql(x: str) -> str:
    low = f"lower({x})"
    return f"""CASE
      WHEN regexp_matches({low}, 'precipitation|precip') THEN 'precip'
      WHEN regexp_matches({low}, 'air') AND regexp_matches({low}, 'temperature|temp') THEN 'air_temp'
      WHEN regexp_matches({low}, 'water') AND regexp_matches({low}, 'temperature|temp') THEN 'water_temp'
      WHEN regexp_matches({low}, 'temperature|temp') THEN 'water_temp'
      WHEN regexp_matches({low}, 'discharge|flow') THEN 'flow'
      WHEN regexp_matches({low}, 'level') AND regexp_matches({low}, 'prim') THEN 'level_prim'
      WHEN regexp_matches({low}, 'level') AND regexp_matches({low}, 'sec') THEN 'level_sec'
      ELSE regexp_replace(regexp_replace({low}, '.csv', '', 'g'), '\\s', '_') END"""


def _label_sql(v: str) -> str:
    return f"""CASE {v} WHEN 'precip' THEN 'Precipitation' WHEN 'air_temp' THEN 'Air Temperature'
      WHEN 'water_temp' THEN 'Water Temperature' WHEN 'flow' THEN 'Flow'
      WHEN 'level_prim' THEN 'Level (Primary Sensor)' WHEN 'level_sec' THEN 'Level (Secondary Sensor)'
      ELSE {v} END"""


def _q(body: str) -> str:
    return "WITH " + _VIEWS.strip() + "\n" + body


def _new_sql(param: str) -> str:
    src = "rt_flow" if param == "Flow" else "rt_level"
    return f"""SELECT r.* FROM {src} r WHERE NOT EXISTS (
      SELECT 1 FROM published p WHERE p.Parameter = '{param}' AND p."Date" >= (SELECT m FROM rt_min)
        AND p.STATION_NUMBER IS NOT DISTINCT FROM r.STATION_NUMBER AND p."Date" IS NOT DISTINCT FROM r."Date")"""


def _first_sql(param: str) -> str:
    src = "rt_flow" if param == "Flow" else "rt_level"
    return f"""SELECT STATION_NUMBER, "Date", Parameter, Value, pub_status FROM (
      SELECT *, row_number() OVER (PARTITION BY STATION_NUMBER, "Date" ORDER BY src) AS rn FROM (
        SELECT STATION_NUMBER, "Date", '{param}' AS Parameter, Value, 'Unpublished' AS pub_status, 0 AS src
        FROM scraped WHERE Parameter = '{param}'
        UNION ALL SELECT *, 1 AS src FROM {src}) u) w
    WHERE rn = 1"""


def _empty_tables_sql() -> str:
    names = [t for t in EXPECTED_TABLES if t != "version"]
    parts = [f"SELECT '{t}' AS table_name WHERE NOT EXISTS (SELECT 1 FROM {t})" for t in names]
    return "\nUNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    return _own_oracle_sql() | (llm.oracle_sql() if llm else {})


def _own_oracle_sql() -> dict[str, str]:
    published_daily_sql = """SELECT STATION_NUMBER, user_id, "Date", Parameter, Value, 'Published' AS pub_status
      FROM daily WHERE Parameter IN ('Flow', 'Level')
        AND STATION_NUMBER IN (SELECT STATION_NUMBER FROM stations WHERE PROV_TERR_STATE_LOC = 'BC')"""
    split = """SELECT STATION_NUMBER, "Date", Parameter, Value, 'Unpublished' AS pub_status FROM daily
      WHERE Parameter = '{p}'
        AND STATION_NUMBER IN (SELECT STATION_NUMBER FROM stations WHERE PROV_TERR_STATE_LOC = 'BC')"""
    variants = ", ".join(f"('{p}', '{h}')" for p, h in HEADING_VARIANTS)
    variant_files = f"""vf AS (
      SELECT DISTINCT r.STATION_NUMBER, v.heading || '.csv' AS file_name
      FROM readings r JOIN (VALUES {variants}) v(Parameter, heading) ON r.Parameter = v.Parameter)"""
    raw_parse = f"""SELECT r.STATION_NUMBER, {_variable_sql("h.heading || '.csv'")} AS variable,
        h.heading || '.csv' AS file_name,
        CAST(10 + row_number() OVER (PARTITION BY r.STATION_NUMBER, r.Parameter ORDER BY r.event_id) AS INTEGER)
          AS line_no,
        r.ts AS "Date", r.Parameter, r.Value, 'Provisional' AS Approval,
        CASE WHEN r.user_id % 2 = 0 THEN r.Grade END AS Grade
      FROM readings r JOIN headings h ON r.Parameter = h.Parameter"""
    large_station = f"'08' || lpad(CAST(r.user_id % {LARGE_FILE_STATIONS} AS VARCHAR), 5, '0')"
    raw_split = f"""SELECT {large_station} AS STATION_NUMBER, {_variable_sql("h.heading || '.csv'")} AS variable,
        h.heading || '.csv' AS file_name,
        CAST(10 + row_number() OVER (PARTITION BY r.user_id % {LARGE_FILE_STATIONS}, r.Parameter ORDER BY r.event_id) AS INTEGER)
          AS line_no,
        r.ts AS "Date", r.Parameter, r.Value, 'Provisional' AS Approval,
        CASE WHEN r.user_id % 2 = 0 THEN r.Grade END AS Grade
      FROM readings r JOIN headings h ON r.Parameter = h.Parameter"""
    masters_sql = f"""SELECT {_variable_sql("h.heading || '.csv'")} AS variable, r.STATION_NUMBER, r.d AS "Date",
        {_label_sql(_variable_sql("h.heading || '.csv'"))} AS Parameter,
        round(avg(r.Value), 4) AS Value, 'Provisional' AS Approval,
        CASE WHEN r.user_id % 2 = 0 THEN arg_min(r.Grade, (r.ts, r.event_id)) END AS Grade
      FROM readings r JOIN headings h ON r.Parameter = h.Parameter
      GROUP BY r.STATION_NUMBER, r.user_id, r.Parameter, h.heading, r.d"""
    stamp = """CASE WHEN strpos(html, 'Hydat_sqlite3_') > 0
        AND regexp_matches(substr(regexp_replace(html, '(?s)^.*Hydat_sqlite3_', ''), 1, 8), '^[0-9]{8}$')
        THEN substr(regexp_replace(html, '(?s)^.*Hydat_sqlite3_', ''), 1, 8) END"""
    expected = ", ".join(f"('{t}')" for t in EXPECTED_TABLES)
    file_issue = """fs AS (
      SELECT STATION_NUMBER, count(*) AS n_files, max(CASE WHEN user_id % 5 = 0 THEN 0 ELSE 1 END) AS has_rows
      FROM files GROUP BY STATION_NUMBER)"""
    return {
        "published_daily": _q(published_daily_sql),
        "split_flow": _q(split.format(p="Flow")),
        "split_level": _q(split.format(p="Level")),
        "station_metadata": _q("""SELECT STATION_NUMBER, STATION_OPERATING_STATUS, PROV_TERR_STATE_LOC
            FROM stations WHERE PROV_TERR_STATE_LOC = 'BC'"""),
        "active_stations": _q("SELECT * FROM active"),
        "sample_stations": _q(f"""SELECT * FROM active
            ORDER BY md5('{SAMPLE_SEED}:' || STATION_NUMBER), STATION_NUMBER LIMIT {SAMPLE_N}"""),
        "station_lonlat": _q("""SELECT STATION_NUMBER, STATION_OPERATING_STATUS, PROV_TERR_STATE_LOC,
            CAST(-120 - c_custkey % 10 AS DOUBLE) AS longitude, CAST(49 + c_custkey % 11 AS DOUBLE) AS latitude
            FROM stations"""),
        "raw_file_parse": _q(raw_parse),
        "raw_lines_split": _q(raw_split),
        "stored_since": _q("""SELECT * FROM daily WHERE "Date" >= DATE '2024-01-10'"""),
        "append_new": _q("""SELECT * FROM published WHERE Parameter = 'Flow'
            UNION ALL SELECT n.*, CAST(NULL AS BIGINT) AS user_id FROM (""" + _new_sql("Flow") + ") n"),
        "append_store": _q(f"""SELECT * FROM published UNION ALL
            SELECT n.*, CAST(NULL AS BIGINT) AS user_id FROM ({_new_sql("Flow")} UNION ALL {_new_sql("Level")}) n"""),
        "integrate_store": _q("""SELECT * FROM published UNION ALL
            SELECT r.* FROM realtime r WHERE NOT EXISTS (SELECT 1 FROM published p
            WHERE p.STATION_NUMBER IS NOT DISTINCT FROM r.STATION_NUMBER AND p."Date" IS NOT DISTINCT FROM r."Date"
              AND p.Parameter IS NOT DISTINCT FROM r.Parameter)"""),
        "release_gate": _q(f"""SELECT page_id, release_stamp, stored_stamp, release_stamp <> stored_stamp AS changed
            FROM (SELECT page_id, {stamp} AS release_stamp FROM listing) s,
              (SELECT min({stamp}) AS stored_stamp FROM listing) f"""),
        "masters_csv_roundtrip": _q("""SELECT m.STATION_NUMBER, m."Date", m.Parameter, m.Value, 'Unpublished' AS pub_status
            FROM daily m WHERE m.Parameter IN ('Flow', 'Level') AND NOT EXISTS (SELECT 1 FROM published p
            WHERE p.Parameter = m.Parameter AND p.STATION_NUMBER = m.STATION_NUMBER AND p."Date" = m."Date")"""),
        "realtime_update": _q(f""", mf AS ({_first_sql('Flow')}), ml AS ({_first_sql('Level')}),
            mm AS (SELECT min("Date") AS m FROM (SELECT "Date" FROM mf UNION ALL SELECT "Date" FROM ml) x)
            SELECT f.* FROM mf f WHERE NOT EXISTS (SELECT 1 FROM published p WHERE p.Parameter = 'Flow'
              AND p."Date" >= (SELECT m FROM mm) AND p.STATION_NUMBER IS NOT DISTINCT FROM f.STATION_NUMBER
              AND p."Date" IS NOT DISTINCT FROM f."Date")
            UNION ALL
            SELECT l.* FROM ml l WHERE NOT EXISTS (SELECT 1 FROM published p WHERE p.Parameter = 'Level'
              AND p."Date" >= (SELECT m FROM mm) AND p.STATION_NUMBER IS NOT DISTINCT FROM l.STATION_NUMBER
              AND p."Date" IS NOT DISTINCT FROM l."Date")"""),
        "resolve_columns": _q("""SELECT ts AS "Date", Parameter, Value, Grade, STATION_NUMBER, event_id
            FROM readings"""),
        "parameter_label": _q(f""", {variant_files}
            SELECT STATION_NUMBER, file_name, {_variable_sql('file_name')} AS variable,
              {_label_sql(_variable_sql('file_name'))} AS Parameter FROM vf"""),
        "variable_name": _q(f""", {variant_files}
            SELECT STATION_NUMBER, file_name, {_variable_sql('file_name')} AS variable FROM vf"""),
        "new_flow_rows": _q(_new_sql("Flow")),
        "new_flow_rows_in_place": _q(_new_sql("Flow")),
        "new_level_rows": _q(_new_sql("Level")),
        "unaffected_rows": _q("""SELECT r.* FROM realtime r WHERE NOT EXISTS (SELECT 1 FROM published p
            WHERE p.STATION_NUMBER IS NOT DISTINCT FROM r.STATION_NUMBER AND p."Date" IS NOT DISTINCT FROM r."Date"
              AND p.Parameter IS NOT DISTINCT FROM r.Parameter)"""),
        "union_published_unpublished": _q("""SELECT * FROM published UNION ALL
            SELECT STATION_NUMBER, "Date", Parameter, Value, pub_status, CAST(NULL AS BIGINT) FROM realtime"""),
        "integrate_publication": _q("""SELECT * FROM published UNION ALL
            SELECT r.* FROM realtime r WHERE NOT EXISTS (SELECT 1 FROM published p
            WHERE p.STATION_NUMBER IS NOT DISTINCT FROM r.STATION_NUMBER AND p."Date" IS NOT DISTINCT FROM r."Date"
              AND p.Parameter IS NOT DISTINCT FROM r.Parameter)"""),
        "reset_tables": _q("SELECT *, 'Published' AS pub_status FROM daily WHERE Parameter IN ('Flow', 'Level')"),
        "daily_mean_first": _q("""SELECT STATION_NUMBER, Parameter, d AS "Date", round(avg(Value), 4) AS Value,
            arg_min(Grade, (ts, event_id)) AS Grade, arg_min(event_id, (ts, event_id)) AS event_id,
            arg_min(user_id, (ts, event_id)) AS user_id
            FROM readings GROUP BY STATION_NUMBER, Parameter, d"""),
        "realtime_daily_mean": _q("""SELECT STATION_NUMBER, d AS "Date", Parameter, round(avg(Value), 4) AS Value
            FROM readings GROUP BY STATION_NUMBER, d, Parameter"""),
        "realtime_daily_mean_poison": _q("""SELECT STATION_NUMBER, d AS "Date", Parameter,
            CASE WHEN count(Value) = count(*) THEN round(avg(Value), 4) END AS Value
            FROM readings GROUP BY STATION_NUMBER, d, Parameter"""),
        "min_update_date": _q("SELECT min(\"Date\") AS min_date FROM daily WHERE Parameter IN ('Flow', 'Level')"),
        "empty_stations": _q("""SELECT STATION_NUMBER, count(*) AS n_files FROM files WHERE user_id % 5 = 0
            GROUP BY STATION_NUMBER"""),
        "problem_stations": _q(f""", {file_issue}
            SELECT DISTINCT station_id, issue FROM (
              SELECT a.STATION_NUMBER AS station_id,
                CASE WHEN fs.n_files IS NULL THEN 'Unable to find download links/no downloadable data found'
                     WHEN fs.has_rows = 0 THEN 'All data files are empty' END AS issue
              FROM active a LEFT JOIN fs ON a.STATION_NUMBER = fs.STATION_NUMBER) x
            WHERE issue IS NOT NULL"""),
        "extraction_summary": _q("""SELECT STATION_NUMBER AS station_id,
            string_agg(file_name, ', ' ORDER BY file_name) AS tables_extracted FROM files GROUP BY STATION_NUMBER"""),
        "coverage_pct": _q("""SELECT count(*) AS n_stations, count(f.STATION_NUMBER) AS n_done,
            round(count(f.STATION_NUMBER) * 100.0 / count(*), 2) AS coverage_pct
            FROM active a LEFT JOIN (SELECT DISTINCT STATION_NUMBER FROM files) f
              ON a.STATION_NUMBER = f.STATION_NUMBER"""),
        "scraped_first_flow": _q(_first_sql("Flow")),
        "scraped_first_level": _q(_first_sql("Level")),
        "missing_tables": f"""SELECT table_name FROM (VALUES {expected}) v(table_name)
            EXCEPT SELECT table_name FROM information_schema.tables""",
        "empty_tables": _empty_tables_sql(),
        "masters": _q(masters_sql),
        "masters_newest_file": _q(masters_sql),
        "masters_whole_stations": _q(masters_sql.replace("GROUP BY", f"""WHERE r.user_id % {EMPTIED_EVERY} <> 0 AND NOT
            (r.user_id % {HEADLESS_EVERY} = 0 AND r.user_id IN (SELECT user_id FROM readings WHERE Parameter = 'Level'))
      GROUP BY""")),
        "file_stats": _q(f"""SELECT f.STATION_NUMBER, f.file_name, {_variable_sql("f.file_name")} AS variable,
            CAST(CASE WHEN f.user_id % {EMPTIED_EVERY} = 0 THEN 0 ELSE r.n END AS INTEGER) AS n_rows,
            f.Parameter <> 'Level' OR f.user_id % {HEADLESS_EVERY} <> 0 AS header_ok
            FROM files f JOIN (SELECT STATION_NUMBER, Parameter, count(*) AS n FROM readings GROUP BY ALL) r
              ON f.STATION_NUMBER = r.STATION_NUMBER AND f.Parameter = r.Parameter"""),
        "station_issues": _q(f"""SELECT DISTINCT station_id, issue FROM (
              SELECT a.STATION_NUMBER AS station_id,
                CASE WHEN fs.user_id IS NULL THEN 'Unable to find download links/no downloadable data found'
                     WHEN fs.user_id % {EMPTIED_EVERY} = 0 THEN 'All data files are empty'
                     WHEN fs.level_files > 0 AND fs.user_id % {HEADLESS_EVERY} = 0
                       THEN 'A fatal error occured during data download for this station' END AS issue
              FROM active a LEFT JOIN (SELECT STATION_NUMBER, user_id, count(*) FILTER (WHERE Parameter = 'Level') AS level_files
                FROM files GROUP BY STATION_NUMBER, user_id) fs ON a.STATION_NUMBER = fs.STATION_NUMBER
              UNION ALL SELECT STATION_NUMBER, '{LOGGED_ISSUE}' FROM stations WHERE PROV_TERR_STATE_LOC = 'AB') x
            WHERE issue IS NOT NULL"""),
        "stream_update": _q("""SELECT STATION_NUMBER, "Date", Parameter, Value, pub_status FROM published
            UNION ALL SELECT STATION_NUMBER, "Date", Parameter, Value, 'Unpublished' FROM daily
              WHERE Parameter IN ('Flow', 'Level') AND NOT ("Date" < DATE '2024-01-16' AND user_id % 7 <> 0)"""),
        "release_stamp": _q(f"SELECT page_id, {stamp} AS release_stamp FROM listing"),
        "pub_status_row": _q(f"""SELECT 'Hydat_sqlite3_' || s || '.zip' AS filename,
            'archive/Hydat_sqlite3_' || s || '.zip' AS path, CAST(strptime(s, '%Y%m%d') AS TIMESTAMP) AS pub_dttm,
            CAST(strptime(s, '%Y%m%d') AS DATE) AS pub_date FROM (SELECT {stamp} AS s FROM listing) l"""),
        "empty_views": _q("""SELECT 'stored_none' AS table_name
            WHERE (SELECT count(*) FROM daily WHERE "Date" > DATE '2999-12-31') = 0
            UNION ALL SELECT 'published' WHERE (SELECT count(*) FROM published) = 0"""),
        "release_changed": _q(f"""SELECT page_id, release_stamp, '20240115' AS stored_stamp,
            release_stamp <> '20240115' AS changed
            FROM (SELECT page_id, {stamp} AS release_stamp FROM listing) s"""),
        "freshness": """SELECT p AS last_publication, u AS last_update,
            round((epoch_us(u) - epoch_us(p)) / 86400e6, 2) AS days_ahead
            FROM (SELECT max(o_orderdate) AS p FROM orders) a, (SELECT max(ts) AS u FROM events) b""",
        "download_manifest": _q("""SELECT STATION_NUMBER, DATE '2024-01-31' - 547 AS start_date,
            DATE '2024-01-31' AS end_date,
            'https://wateroffice.ec.gc.ca/report/real_time_e.html?stn=' || STATION_NUMBER || '&mode=Graph&startDate='
              || CAST(DATE '2024-01-31' - 547 AS VARCHAR) || '&endDate=2024-01-31'
              || '&prm1=46&y1Max=&y1Min=&prm2=-1&y2Max=&y2Min=' AS url
            FROM active"""),
        "is_leap_year": """SELECT year, (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 AS is_leap FROM (
            SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
            UNION SELECT * FROM (VALUES (1900), (2000), (2100)) v(year)) y""",
    }
