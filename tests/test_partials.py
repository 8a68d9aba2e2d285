"""Split days, late readings, replayed batches and publications, against the batch job."""

import datetime as dt

import pytest

from gaugekeep.operators.daily import realtime_daily_mean
from gaugekeep.plans.integrate import run_integrate
from gaugekeep.plans.partials import PARTIALS, add_readings
from gaugekeep.plans.realtime import run_realtime_update
from gaugekeep.sinks.snapshots import TableStore

READINGS = "STATION_NUMBER string, Date timestamp_ntz, Parameter string, Value double"
STORED = "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string"


def _contents(store):
    rows = store.read("flow").unionByName(store.read("level"))
    return sorted((str(r.STATION_NUMBER), str(r.Date), r.Parameter, str(None if r.Value is None else round(r.Value, 9)), r.pub_status)
                  for r in rows.collect())


def _start(spark, root):
    """A published flow day and a level day that another source stored."""
    store = TableStore(spark, root)
    store.replace("flow", spark.createDataFrame([("a", dt.date(2024, 1, 1), "Flow", 1.0, "Published")], STORED))
    store.replace("level", spark.createDataFrame([("a", dt.date(2024, 1, 2), "Level", 2.0, "Unpublished")], STORED))
    return store


def _readings():
    """Days over two years, missing values, null station, null time, a third parameter."""
    rows = [(s, dt.datetime(2023, 12, 30) + dt.timedelta(hours=5 * k), p, None if k % 6 == 0 else float(k * 7 + len(p)))
            for k in range(24) for s in ("a", "b", None) for p in ("Flow", "Level", "Other")]
    return [*rows, ("b", None, "Flow", 3.0), ("b", None, "Flow", 5.0), ("c", dt.datetime(2024, 1, 3), "Flow", None),
            ("c", dt.datetime(2024, 1, 4), "Flow", float("nan")), ("c", dt.datetime(2024, 1, 4, 5), "Flow", 2.0)]


@pytest.mark.parametrize("null_policy", ["skip", "poison"])
def test_any_split_of_the_readings_gives_the_batch_job(spark, scratch, null_policy):
    rows = _readings()
    want = _start(spark, scratch + "/b")
    run_realtime_update(want, realtime_daily_mean(spark.createDataFrame(rows, READINGS), null_policy=null_policy))
    store = _start(spark, scratch + "/s")
    for batch in range(4):  # every day spans batches; batch 3 is all late
        part = spark.createDataFrame(rows[3 - batch::4], READINGS)
        add_readings(store, part, "one", batch, null_policy=null_policy, fold_every=2)
    assert _contents(store) == _contents(want)
    number = store.snapshot().number
    assert add_readings(store, part, "one", 3, null_policy=null_policy) == {"added": 0, "changed": 0}  # run again
    assert store.snapshot().number == number


def test_late_reading_changes_its_day_until_published(spark, scratch):
    store = _start(spark, scratch)
    day, noon = dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 12)

    def read(value, batch):
        return add_readings(store, spark.createDataFrame([("a", noon, "Flow", value)], READINGS), "one", batch)

    def stored():
        return [(r.Value, r.pub_status) for r in store.read("flow").filter(f"Date = DATE '{day}'").collect()]

    assert read(10.0, 0) == {"added": 1, "changed": 0} and stored() == [(10.0, "Unpublished")]
    assert read(20.0, 1) == {"added": 0, "changed": 1} and stored() == [(15.0, "Unpublished")]
    run_integrate(store, spark.createDataFrame([("a", day, "Flow", 99.0, "Published")], STORED))
    assert read(30.0, 2) == {"added": 0, "changed": 0} and stored() == [(99.0, "Published")]
    add_readings(store, spark.createDataFrame([], READINGS), "one", 3, fold_every=4)
    assert store.read(PARTIALS).count() == 0  # a published day needs no sums
    other = spark.createDataFrame([("a", dt.datetime(2024, 1, 2), "Level", 50.0)], READINGS)
    assert add_readings(store, other, "two", 0) == {"added": 0, "changed": 0}  # another source's day


def test_failure_before_the_commit_leaves_the_batch_undone(spark, scratch, monkeypatch):
    store = _start(spark, scratch)
    part = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), "Flow", 4.0)], READINGS)
    before = _contents(store)
    publish = TableStore._publish
    monkeypatch.setattr(TableStore, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        add_readings(store, part, "one", 0)
    monkeypatch.setattr(TableStore, "_publish", publish)
    assert _contents(store) == before
    assert add_readings(store, part, "one", 0) == {"added": 1, "changed": 0}


def test_store_without_tables(spark, scratch):
    store = TableStore(spark, scratch)
    part = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), "Flow", 4.0)], READINGS)
    assert add_readings(store, part, "one", 0) == {"added": 1, "changed": 0}
    assert [r[1:4] for r in _contents(store)] == [("2024-01-05", "Flow", "4.0")]
