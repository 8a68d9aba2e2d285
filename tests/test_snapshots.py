"""K1-K4 and the jobs C1-C3 run against a snapshot store; C3 is idempotent."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugekeep.plans.integrate import run_integrate
from gaugekeep.plans.realtime import run_realtime_update
from gaugekeep.plans.reset import run_reset
from gaugekeep.sinks.files import write_csv, write_report
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources.csvfiles import read_master_csv, read_pub_status
from gaugekeep.sources import stand_ins as si
from gaugekeep.plans.freshness import freshness, freshness_report

from sample_paths import SF_SMALL


def test_reset_integrate_update_cycle(spark, scratch):
    store = TableStore(spark, scratch + "/db")
    pub = si.published(spark, SF_SMALL)
    run_reset(store, pub)
    n_pub = pub.count()
    assert store.read("flow").count() + store.read("level").count() == n_pub
    v1 = store.snapshot().number

    daily = si.realtime(spark, SF_SMALL).drop("pub_status", "user_id")
    run_realtime_update(store, daily)
    after_one = store.read("flow").count() + store.read("level").count()
    assert after_one == n_pub + 85 + 89        # J1 counts at sf0.001
    assert "user_id" in store.read("flow").columns  # absent column appended as NULL
    run_realtime_update(store, daily)
    assert store.read("flow").count() + store.read("level").count() == after_one  # rerun adds nothing

    keys = store.read("flow").groupBy("STATION_NUMBER", "Date").count().filter("count > 1")
    assert keys.count() == 0

    run_integrate(store, pub)
    assert store.snapshot().number > v1
    merged = store.read("flow").unionByName(store.read("level"))
    assert merged.count() == after_one          # every realtime row is either published or kept
    assert merged.filter("pub_status = 'Published'").count() == n_pub


def test_failed_replace_keeps_previous_version(spark, scratch):
    store = TableStore(spark, scratch + "/db")
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), "Flow", 1.0, "Published")],
                               "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string")
    store.replace("flow", df)
    bad = df.withColumn("Value", F.col("Value") / F.lit(0).cast("int"))  # ANSI: division by zero fails the job
    with pytest.raises(Exception):
        store.replace("flow", bad)
    assert store.read("flow").collect()[0].Value == 1.0


def test_append_refuses_unknown_columns(spark, scratch):
    store = TableStore(spark, scratch + "/db")
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), 1.0)], "STATION_NUMBER string, Date date, Value double")
    store.replace("t", df)
    with pytest.raises(ValueError):
        store.append("t", df.withColumn("other", F.lit(1)))


def test_stored_since_prunes_year_partitions(spark, scratch):
    from gaugekeep.sources.archive import stored_since
    store = TableStore(spark, scratch + "/db")
    df = spark.createDataFrame([("s", dt.date(2023, 12, 31), 1.0), ("s", dt.date(2024, 1, 2), 2.0)],
                               "STATION_NUMBER string, Date date, Value double")
    store.replace("t", df)
    q = stored_since(store.read("t", keep_year=True), "2024-01-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(Date), GreaterThanOrEqual(Date" in plan
    assert [r.Value for r in q.collect()] == [2.0]


def test_csv_round_trips(spark, scratch):
    m = spark.createDataFrame([(dt.date(2024, 1, 1), "Flow", None, "08A", "P", None)],
                              "Date date, Parameter string, Value double, STATION_NUMBER string, Approval string, Grade string")
    write_csv(m, scratch + "/flow_current")
    back = read_master_csv(spark, scratch + "/flow_current").collect()
    assert back == m.collect()
    with open(scratch + "/pub.csv", "w") as f:
        f.write("filename,path,pub_dttm,pub_date\nHydat.sqlite3,/x/Hydat.sqlite3,2024-01-15 10:20:30,2024-01-15\n")
    st = read_pub_status(spark, scratch + "/pub.csv").collect()[0]
    assert st.pub_dttm == dt.datetime(2024, 1, 15, 10, 20, 30) and st.pub_date == dt.date(2024, 1, 15)


def test_freshness_report_text(spark, scratch):
    pubs = spark.createDataFrame([(dt.datetime(2024, 1, 15),)], "t timestamp_ntz")
    upd = spark.createDataFrame([(dt.datetime(2024, 1, 20, 12),)], "t timestamp_ntz")
    fr = freshness(pubs, "t", upd, "t")
    assert fr.collect()[0].days_ahead == 5.5
    write_report(freshness_report(fr), scratch + "/report")
    text = spark.read.text(scratch + "/report", wholetext=True).collect()[0].value
    assert "5.5 days" in text


def test_station_csv_and_stored_stamp(spark, scratch):
    from gaugekeep.plans.release import release_changed, stored_stamp
    from gaugekeep.sources.csvfiles import read_stations_csv
    with open(scratch + "/stations.csv", "w") as f:
        f.write("STATION_NUMBER,STATION_OPERATING_STATUS,longitude,latitude\n08A,ACTIVE,-120.5,49.1\n08B,,-121,50\n")
    st = read_stations_csv(spark, scratch + "/stations.csv",
                           "STATION_NUMBER string, STATION_OPERATING_STATUS string, longitude double, latitude double")
    rows = st.collect()
    assert rows[1].STATION_OPERATING_STATUS is None and rows[0].longitude == -120.5
    with open(scratch + "/pub.csv", "w") as f:
        f.write("filename,path,pub_dttm,pub_date\nH.sqlite3,/x/H.sqlite3,2024-01-15 00:00:00,2024-01-15\n")
    pub = read_pub_status(spark, scratch + "/pub.csv")
    listing = spark.createDataFrame([(1, "x Hydat_sqlite3_20240115.zip"), (2, "Hydat_sqlite3_20240415.zip")],
                                    "page_id long, html string")
    out = {r.page_id: (r.stored_stamp, r.changed) for r in release_changed(listing, stored_stamp(pub)).collect()}
    assert out == {1: ("20240115", False), 2: ("20240115", True)}


def test_compact_keeps_rows_and_previous_version(spark, scratch):
    store = TableStore(spark, scratch + "/db")
    df = spark.createDataFrame([("s", dt.date(2024, 1, d), float(d)) for d in range(1, 6)],
                               "STATION_NUMBER string, Date date, Value double")
    store.replace("t", df.limit(1))
    for d in range(2, 6):
        store.append("t", df.filter(F.col("Value") == float(d)))
    before = store.snapshot()
    assert len(before.folders("t")["year=2024"]) == 5
    after = store.compact("t", files_per_year=1)
    assert after == before.number + 1 and len(store.snapshot().folders("t")["year=2024"]) == 1
    assert sorted(r.Value for r in store.read("t").collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert before.read("t").count() == 5      # previous state still readable
    store.drop_versions("t", keep=1)
    assert store.versions() == [after] and store.read("t").count() == 5
    assert len(store._names("t", True)) == 1


SCHEMA = "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string"


def _rows(spark, rows):
    return spark.createDataFrame([(s, d and dt.date.fromisoformat(d), "Flow", v, st) for s, d, v, st in rows], SCHEMA)


def _files(store, table):
    import glob
    snap = store.snapshot()
    return {n: sorted(f for p in paths for f in glob.glob(f"{store.root}/{p}/*.parquet")) for n, paths in snap.folders(table).items()}


def test_publication_writes_only_the_years_it_changes(spark, scratch):
    from gaugekeep.plans.integrate import integrate_publication
    store = TableStore(spark, scratch + "/db")
    old = [("a", "2021-05-01", 1.0, "Published"), ("a", "2022-05-01", 2.0, "Published"), ("a", "2022-05-02", 2.5, "Unpublished"),
           ("b", "2023-05-01", 3.0, "Published"), ("b", "2023-05-02", 4.0, "Unpublished"), (None, None, 9.0, "Unpublished")]
    store.replace("flow", _rows(spark, old))
    before, first = _files(store, "flow"), store.snapshot()
    # 2021 as stored, 2022 with another value, 2023 covers an unpublished row, 2024 is new
    pub = _rows(spark, [("a", "2021-05-01", 1.0, None), ("a", "2022-05-01", 2.25, None), ("b", "2023-05-01", 3.0, None),
                        ("b", "2023-05-02", 4.0, None), ("c", "2024-01-01", 5.0, None)]).drop("pub_status")
    want = sorted(map(repr, integrate_publication(pub, store.read("flow")).select(*store.read("flow").columns).collect()))
    assert run_integrate(store, pub)["flow"] == [2022, 2023, 2024]
    after = _files(store, "flow")
    assert sorted(map(repr, store.read("flow").collect())) == want
    assert after["year=2021"] == before["year=2021"] and after["year=__HIVE_DEFAULT_PARTITION__"] == before["year=__HIVE_DEFAULT_PARTITION__"]
    assert all(after[n] != before.get(n) for n in ("year=2022", "year=2023", "year=2024"))
    assert sorted(map(repr, first.read("flow").collect())) == sorted(map(repr, _rows(spark, old).collect()))  # the older state
    number = store.snapshot().number
    assert run_integrate(store, pub)["flow"] == [] and _files(store, "flow") == after  # again: nothing to write
    assert store.snapshot().number == number
    # a new column: null in years that were not written before, all written now
    run_integrate(store, pub.withColumn("symbol", F.lit("E")))
    assert {(r.symbol, r.pub_status) for r in store.read("flow").collect()} == {("E", "Published"), (None, "Unpublished")}


def test_null_and_moved_cells_are_changes(spark, scratch):
    from gaugekeep.plans.integrate import changed_years
    schema = SCHEMA + ", x string, y string"
    row = ("a", dt.date(2020, 1, 1), "Flow", 1.0, "Published")
    stored = spark.createDataFrame([row + ("k", None)], schema)
    assert changed_years(spark.createDataFrame([row + (None, "k")], schema), stored) == [2020]
    assert changed_years(stored, stored) == []
    assert changed_years(stored.unionAll(stored), stored) == [2020]
    assert changed_years(stored.withColumn("Date", F.lit(None).cast("date")), stored) == [None]


def test_both_tables_or_neither(spark, scratch, monkeypatch):
    from gaugekeep.sinks.snapshots import Transaction
    store = TableStore(spark, scratch + "/db")
    run_reset(store, si.published(spark, SF_SMALL))
    counts = store.read("flow").count(), store.read("level").count()
    daily = si.realtime(spark, SF_SMALL).drop("pub_status", "user_id")
    append = Transaction.append

    def fails_at_level(self, table, df):
        if table == "level":
            raise OSError("lost")
        append(self, table, df)

    monkeypatch.setattr(Transaction, "append", fails_at_level)
    with pytest.raises(OSError):
        run_realtime_update(store, daily)
    monkeypatch.undo()
    assert (store.read("flow").count(), store.read("level").count()) == counts
    got = run_realtime_update(store, daily)
    assert (got["flow"], got["level"]) == (85, 89) and store.read("flow").count() == counts[0] + 85
    store.drop_versions()
    assert store.read("level").count() == counts[1] + 89


def test_two_jobs_from_one_snapshot_conflict(spark, scratch):
    from gaugekeep.sinks.snapshots import CommitConflict
    store = TableStore(spark, scratch + "/db")
    store.replace("t", _rows(spark, [("a", "2021-05-01", 1.0, "Published")]))
    one, two = store.transaction(), store.transaction()
    for t in (one, two):
        t.append("t", _rows(spark, [("b", "2021-06-01", 2.0, "Unpublished")]))
    one.commit()
    with pytest.raises(CommitConflict):
        two.commit()
    assert store.read("t").count() == 2
    store.reset(["t"])
    assert store.tables() == [] and not store.exists("t")
    with pytest.raises(FileNotFoundError):
        store.read("t")


def test_update_without_tables_makes_them(spark, scratch):
    store = TableStore(spark, scratch + "/db")
    daily = si.realtime(spark, SF_SMALL).drop("pub_status", "user_id")
    got = run_realtime_update(store, daily)
    assert got["flow"] == store.read("flow").count() > 0 and run_realtime_update(store, daily) == {"flow": 0, "level": 0}
