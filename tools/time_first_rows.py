"""Times of three ways to a day's mean and the attributes of its first line (A1),
on `n` lines of 5-minute readings in file order.

usage: python tools/time_first_rows.py [n]
"""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from gaugekeep.functions.columns import civil_day  # noqa: E402
from gaugekeep.operators.daily import clean_value, daily_mean_first  # noqa: E402
from gaugekeep.session import get_spark  # noqa: E402

KEYS = ["STATION_NUMBER", "file_name"]
LINES_OF_A_FILE = 28_800  # 100 days


def lines(spark, n):
    no = F.col("id") % LINES_OF_A_FILE
    return spark.range(n, numPartitions=16).select(
        F.concat(F.lit("08"), F.lpad((F.col("id") / LINES_OF_A_FILE).cast("int").cast("string"), 5, "0")).alias("STATION_NUMBER"),
        F.lit("Discharge.csv").alias("file_name"), (no + 11).cast("int").alias("line_no"),
        F.timestamp_micros((F.lit(1704067200) + no * 300) * 1_000_000).cast("timestamp_ntz").alias("Date"),
        (F.rand(3) * 100).alias("Value"), F.when(F.col("id") % 7 < 6, "Provisional").otherwise("Final").alias("Approval"),
        F.concat(F.lit("grade "), (F.hash("id") % 10).cast("string")).alias("Grade"))


def sorted_first(rows):
    """The library's: two-phase min_by, which sorts each task's lines."""
    return daily_mean_first(rows, KEYS, "Date", ["line_no"], payload=["Approval", "Grade"])


def fetched_first(rows):
    """Hash aggregate of mean and first line number, then a join for the first lines."""
    day = rows.groupBy(*KEYS, civil_day("Date").alias("day")).agg(F.avg(clean_value("Value")).alias("Value"), F.min("line_no").alias("line_no"))
    return day.join(rows.select(*KEYS, "line_no", "Approval", "Grade"), [*KEYS, "line_no"], "left")


def grouped_first(rows):
    """Hash aggregate with the attributes as keys, then the first of each day's few rows."""
    v = clean_value("Value")
    g = rows.groupBy(*KEYS, civil_day("Date").alias("day"), "Approval", "Grade").agg(
        F.sum(v).alias("s"), F.count(v).alias("c"), F.min("line_no").alias("l"))
    return g.groupBy(*KEYS, "day").agg((F.sum("s") / F.sum("c")).alias("Value"), F.min_by(F.struct("Approval", "Grade"), "l").alias("f"))


def main():
    spark = get_spark("local[8]", shuffle_partitions=16)
    path = tempfile.mkdtemp(prefix="run-") + "/lines"
    lines(spark, int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000).write.parquet(path)
    rows = spark.read.parquet(path)
    for way in (sorted_first, fetched_first, grouped_first):
        took = []
        for _ in range(3):
            t = time.perf_counter()
            way(rows).write.format("noop").mode("overwrite").save()
            took.append(round(time.perf_counter() - t, 2))
        print(way.__name__, took)
    spark.stop()


if __name__ == "__main__":
    main()
