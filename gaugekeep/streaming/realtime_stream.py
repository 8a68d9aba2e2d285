"""The realtime update (C3) driven by a file stream.

Two modes:
* default: each micro-batch adds its sums and counts per station-day to those kept
  of earlier ones (plans.partials), and the days' means follow, until a publication
  covers them. So days that span micro-batches and late readings end as in the
  batch job. A batch that is run again after a failure changes nothing.
* `complete_days=True`: a 1-day event-time window with a watermark, in
  append mode. Each (station, parameter, day) mean is emitted once, when the
  watermark has passed the day's end, however many micro-batches its readings
  span, and appended through J1; the state holds only the partial sums of open
  days. Choose it where a stored day must not change any more: readings later
  than `lateness` behind the newest one are dropped by the watermark, and the
  newest day stays open until later data close it (D16's running day is thus
  never stored half done).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugekeep.columns import DATE, PARAMETER, STATION, VALUE
from gaugekeep.operators.daily import _mean, clean_value
from gaugekeep.plans.partials import add_readings
from gaugekeep.plans.realtime import run_realtime_update
from gaugekeep.sinks.snapshots import TableStore


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream keeps over restarts (its checkpoint's metadata)."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata", schema="id string").first().id


def realtime_stream(spark: SparkSession, source_dir: str, schema, store: TableStore, checkpoint: str,
                    to_readings: Callable[[DataFrame], DataFrame] | None = None, time_col: str = DATE,
                    null_policy: str = "skip", path_glob: str | None = None,
                    max_files_per_trigger: int | None = None, available_now: bool = True,
                    processing_time: str | None = None, complete_days: bool = False,
                    lateness: str = "0 seconds") -> StreamingQuery:
    """Start the stream; returns the running query.

    `to_readings` maps the raw stream rows to readings (STATION_NUMBER,
    `time_col`, Parameter, Value); it must be stateless (select/filter)."""
    r = spark.readStream.schema(schema)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = r.parquet(source_dir)
    if to_readings is not None:
        stream = to_readings(stream)

    if complete_days:
        # Watermarks need TIMESTAMP: the civil (NTZ) time is taken as UTC
        # micros, and the day is read back from the window start's micros, so
        # neither the window alignment nor the day depends on the session zone.
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        event_time = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(time_col)))
        day = F.date_from_unix_date(F.floor(F.unix_micros(F.col("__w.start")) / F.lit(86_400_000_000)).cast("int"))
        stream = (stream.withColumn("__et", event_time).withWatermark("__et", lateness)
                  .groupBy(F.window("__et", "1 day").alias("__w"), STATION, PARAMETER)
                  .agg(_mean(clean_value(VALUE), null_policy).alias(VALUE))
                  .select(STATION, day.alias(DATE), PARAMETER, VALUE))

    def _batch(batch: DataFrame, epoch_id: int) -> None:
        if complete_days:
            run_realtime_update(store, batch)
        else:
            add_readings(store, batch, _stream_id(spark, checkpoint), epoch_id, time_col, null_policy)

    w = stream.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    if complete_days:
        w = w.outputMode("append")
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
