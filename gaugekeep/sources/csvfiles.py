"""Typed CSV reads: scraped master tables (S4), publication status (S7),
station list (S9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASTER_SCHEMA = "Date date, Parameter string, Value double, STATION_NUMBER string, Approval string, Grade string"
# Column order of a masters CSV: its writer and the reader's schema share it.
MASTER_ORDER = tuple(c.split()[0] for c in MASTER_SCHEMA.split(", "))
PUB_STATUS_SCHEMA = "filename string, path string, pub_dttm timestamp_ntz, pub_date date"

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_master_csv(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """A scraped master table written by the masters job (header row,
    `NA` for missing cells). A header in another order or a cell that does
    not fit its type is an error, never a shifted row. With `order_col`, each row gets its position:
    (file path, start of its split in the file, row within the split), so that "the
    earlier row wins" (W1) can be decided within the source, however it is split."""
    df = (spark.read.schema(MASTER_SCHEMA).option("header", "true")
          .option("nullValue", "NA").option("enforceSchema", "false").option("mode", "FAILFAST").csv(path))
    if order_col:
        df = df.withColumn(order_col, F.struct(F.col("_metadata.file_path").alias("file"),
                                               F.col("_metadata.file_block_start").alias("split"),
                                               F.monotonically_increasing_id().alias("pos")))
    return df


def read_pub_status(spark: SparkSession, path: str) -> DataFrame:
    """The publication status row."""
    return (spark.read.schema(PUB_STATUS_SCHEMA).option("header", "true")
            .option("nullValue", "NA").option("timestampNTZFormat", TIME_FORMAT).csv(path))


def read_stations_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Station list exported as CSV."""
    r = spark.read.option("header", "true")
    return (r.schema(schema) if schema else r.option("inferSchema", "false")).csv(path)
