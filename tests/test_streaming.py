"""The streamed realtime update lands the same rows as the batch job."""

from pyspark.sql import functions as F

from gaugekeep.columns import PARAMETER
from gaugekeep.plans.realtime import run_realtime_update
from gaugekeep.plans.reset import run_reset
from gaugekeep.operators.daily import realtime_daily_mean
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources import stand_ins as si
from gaugekeep.streaming.realtime_stream import realtime_stream

from sample_paths import SF_SMALL


def _to_readings(events):
    # the stand-in mapping of events to readings, stateless
    return (events.select(si.station_id(F.col("user_id")).alias("STATION_NUMBER"), "ts",
                          si._mapping(F.col("event_type"), si.EVENT_PARAMETER, si.OTHER_PARAMETER).alias(PARAMETER),
                          F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("Value")))


def _contents(store):
    rows = store.read("flow").unionByName(store.read("level"))
    return sorted((r.STATION_NUMBER, str(r.Date), r.Parameter, r.Value, r.pub_status) for r in rows.collect())


def test_stream_equals_batch(spark, scratch):
    pub = si.published(spark, SF_SMALL)
    batch_store, stream_store = TableStore(spark, scratch + "/b"), TableStore(spark, scratch + "/s")
    run_reset(batch_store, pub)
    run_reset(stream_store, pub)

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    daily = realtime_daily_mean(_to_readings(events), time_col="ts")
    run_realtime_update(batch_store, daily)

    q = realtime_stream(spark, SF_SMALL, events.schema, stream_store, scratch + "/ckpt",
                        to_readings=_to_readings, time_col="ts", path_glob="events.parquet")
    q.awaitTermination(300)
    assert q.exception() is None
    assert _contents(stream_store) == _contents(batch_store)

    # restart on the same checkpoint: nothing new to read, nothing appended
    q2 = realtime_stream(spark, SF_SMALL, events.schema, stream_store, scratch + "/ckpt",
                         to_readings=_to_readings, time_col="ts", path_glob="events.parquet")
    q2.awaitTermination(300)
    assert _contents(stream_store) == _contents(batch_store)


def test_stream_in_many_micro_batches(spark, scratch):
    """One file per day, three files per micro-batch: whole days arrive
    together, so the streamed tables equal the batch job's."""
    pub = si.published(spark, SF_SMALL)
    batch_store, stream_store = TableStore(spark, scratch + "/b"), TableStore(spark, scratch + "/s")
    run_reset(batch_store, pub)
    run_reset(stream_store, pub)

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    daily = realtime_daily_mean(_to_readings(events), time_col="ts")
    run_realtime_update(batch_store, daily)

    by_day = events.withColumn("day", F.to_date("ts"))
    by_day.repartition("day").write.partitionBy("day").parquet(scratch + "/feed")
    schema = spark.read.parquet(scratch + "/feed").schema
    q = realtime_stream(spark, scratch + "/feed", schema, stream_store, scratch + "/ckpt",
                        to_readings=_to_readings, time_col="ts", max_files_per_trigger=3)
    q.awaitTermination(600)
    assert q.exception() is None
    assert len(q.recentProgress) >= 10          # 30 days, 3 per batch
    assert _contents(stream_store) == _contents(batch_store)


def test_complete_days_across_micro_batches(spark, scratch):
    """Six-hour files written in time order, two per micro-batch, so every
    day spans two batches. With the day window and watermark each closed day
    is stored once with its full mean; the newest day stays open."""
    import datetime as dt
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = [(f"08ST00{s}", dt.datetime(2024, 3, 1) + dt.timedelta(hours=3 * k), "Flow" if s % 2 else "Level",
             float(s * 100 + k) if k % 7 else None)
            for k in range(32) for s in range(3)]        # 4 days, every 3 hours
    os.makedirs(scratch + "/feed")
    for part in range(16):                               # 6-hour files, oldest first
        chunk = [r for r in rows if (r[1] - dt.datetime(2024, 3, 1)).total_seconds() // 21600 == part]
        t = pa.table({"STATION_NUMBER": [r[0] for r in chunk], "ts": [r[1] for r in chunk],
                      "Parameter": [r[2] for r in chunk], "Value": [r[3] for r in chunk]})
        pq.write_table(t, f"{scratch}/feed/part-{part:02d}.parquet")
    schema = "STATION_NUMBER string, ts timestamp_ntz, Parameter string, Value double"
    feed = spark.read.schema(schema).parquet(scratch + "/feed")

    empty = spark.createDataFrame([], "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string")
    batch_store, stream_store = TableStore(spark, scratch + "/b"), TableStore(spark, scratch + "/s")
    for st in (batch_store, stream_store):
        st.replace("flow", empty)
        st.replace("level", empty)
    run_realtime_update(batch_store, realtime_daily_mean(feed, time_col="ts"), complete_before=dt.date(2024, 3, 4))

    q = realtime_stream(spark, scratch + "/feed", feed.schema, stream_store, scratch + "/ckpt",
                        time_col="ts", max_files_per_trigger=2, complete_days=True)
    q.awaitTermination(600)
    assert q.exception() is None
    norm = lambda c: [(a, b, p, None if v is None else round(v, 9), s) for a, b, p, v, s in c]
    got = norm(_contents(stream_store))
    assert got == norm(_contents(batch_store))
    assert len(got) == 9 and {r[1] for r in got} == {"2024-03-01", "2024-03-02", "2024-03-03"}
