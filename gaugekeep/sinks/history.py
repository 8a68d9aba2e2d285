"""Stored history laid out for J1 and J2: cut into buckets by station and day, so that
the anti-join reads it in place and only the incoming rows are shuffled, to it.

Bucketing lives in the session's catalog; the files alone tell where a row lies. So a
later session names the folder again (open_history) with the same bucket count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, DAY_KEYS, STATION

BUCKET_ROWS = 20_000_000


def buckets_for(rows: int) -> int:
    """Buckets of about BUCKET_ROWS rows each."""
    return max(1, -(-rows // BUCKET_ROWS))


def write_history(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write `df` as bucketed table `table` at `path`: one shuffle, one file a bucket,
    rows by station and day. Returns the stored table."""
    cut = df.repartition(buckets, *[F.col(k) for k in DAY_KEYS])
    cut.write.format("parquet").bucketBy(buckets, STATION, DATE).sortBy(STATION, DATE).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_history(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """The table that write_history wrote, in a session that doesn't know it yet."""
    columns = spark.read.parquet(path).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet CLUSTERED BY ({STATION}, {DATE}) "
              f"SORTED BY ({STATION}, {DATE}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(table)
