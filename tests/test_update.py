"""The update job as one call, the masters on disk, versions and listings."""

import datetime as dt
import os

from gaugekeep.operators.reports import list_tables
from gaugekeep.plans.masters import run_masters
from gaugekeep.plans.update import run_update
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources.rawfiles import read_raw_files

DAILY = "STATION_NUMBER string, Date date, Parameter string, Value double"
DAY = dt.date


def _inputs(spark, stamp):
    stations = spark.createDataFrame([("08A", "BC"), ("05B", "AB")], "STATION_NUMBER string, PROV_TERR_STATE_LOC string")
    listing = spark.createDataFrame([(1, f"x Hydat_sqlite3_{stamp}.zip"), (2, "no stamp"), (3, None)], "page_id int, html string")
    pub = spark.createDataFrame([("08A", DAY(2024, 1, 1), "Flow", 1.0), ("08A", DAY(2024, 1, 1), "Level", 2.0),
                                 ("05B", DAY(2024, 1, 1), "Flow", 9.0)], DAILY)
    readings = spark.createDataFrame(
        [("08A", dt.datetime(2024, 1, 1, 5), "Flow", 7.0), ("08A", dt.datetime(2024, 1, 2, 5), "Flow", 1.0),
         ("08A", dt.datetime(2024, 1, 2, 6), "Flow", 9.0), ("05B", dt.datetime(2024, 1, 2, 5), "Flow", 3.0)],
        "STATION_NUMBER string, Date timestamp_ntz, Parameter string, Value double")
    return listing, "archive/release.zip", pub, readings, stations, "BC"


def test_update_integrates_once_per_release(spark, scratch):
    store = TableStore(spark, scratch + "/db")
    got = run_update(store, *_inputs(spark, "20240115"), report_path=scratch + "/report")
    assert got == {"integrated": True, "flow": 1, "level": 0}
    flow = {(r.STATION_NUMBER, r.Date): (r.Value, r.pub_status) for r in store.read("flow").collect()}
    assert flow == {("08A", DAY(2024, 1, 1)): (1.0, "Published"), ("08A", DAY(2024, 1, 2)): (5.0, "Unpublished")}
    status = store.read("pub_status").collect()
    assert [(r.filename, r.path, r.pub_dttm, r.pub_date) for r in status] == [
        ("release.zip", "archive/release.zip", dt.datetime(2024, 1, 15), DAY(2024, 1, 15))]
    assert store.read("station_metadata").count() == 1
    text = spark.read.text(scratch + "/report").collect()
    assert any("2024-01-15" in r.value for r in text)
    version = store.snapshot().folders("flow")
    assert run_update(store, *_inputs(spark, "20240115")) == {"integrated": False, "flow": 0, "level": 0}
    assert store.snapshot().folders("flow") == version
    # an older stamp than the stored one counts as a new release too
    assert run_update(store, *_inputs(spark, "20231115"))["integrated"]
    assert store.read("flow").count() == 2


def test_masters_keep_other_columns_and_dayless_rows(spark, scratch):
    folder = scratch + "/raw/08AA001"
    os.makedirs(folder)
    head = [f"meta {i}" for i in range(9)]
    with open(folder + "/Discharge.csv", "w") as f:
        f.write("\n".join(head + ["Date,Parameter,Value,Qualifier", "2024-01-01 00:00:00,47,1.0,e", ",47,4.0,x", "bad,47,6.0,y"]) + "\n")
    run_masters(read_raw_files(spark, scratch + "/raw"), scratch + "/masters")
    rows = {r.Date: r for r in spark.read.parquet(scratch + "/masters").collect()}
    assert rows[DAY(2024, 1, 1)].Value == 1.0 and rows[None].Value == 5.0
    assert [(e.name, e.value) for e in rows[DAY(2024, 1, 1)].extra] == [("Qualifier", "e")]
    assert [(e.name, e.value) for e in rows[None].extra] == [("Qualifier", "x")]


def test_files_without_a_commit_do_not_count(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.createDataFrame([("a", DAY(2024, 1, 1), "Flow", 1.0)], DAILY)
    store.replace("flow", df.limit(0))
    assert store.read("flow").columns == df.columns and store.read("flow").count() == 0
    store.replace("flow", df)
    store.transaction().append("flow", df)  # never committed
    assert len(os.listdir(scratch + "/flow")) == 3
    assert store.read("flow").count() == 1
    store.drop_versions("flow")
    assert store.read("flow").count() == 1 and len(os.listdir(scratch + "/flow")) == 1


def test_list_tables_is_the_first_level(spark, scratch):
    spark.range(10).repartition(3).write.parquet(scratch + "/many.parquet")
    open(scratch + "/notes.txt", "w").close()
    os.makedirs(scratch + "/ev")
    spark.range(1).write.parquet(scratch + "/ev/inner.parquet")
    assert [r.table_name for r in list_tables(spark, scratch).collect()] == ["many"]
