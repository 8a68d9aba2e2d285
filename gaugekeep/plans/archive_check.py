"""Archive completeness: expected tables that are missing, present
tables that hold no row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugekeep.operators.reports import empty_tables, list_tables, missing_tables


def missing_archive_tables(spark: SparkSession, folder: str, expected: list[str]) -> DataFrame:
    exp = spark.createDataFrame([(t,) for t in expected], "table_name string")
    return missing_tables(exp, list_tables(spark, folder))


def empty_archive_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Present tables (listed from the folder) without any row."""
    names = [r.table_name for r in list_tables(spark, folder).orderBy("table_name").collect()]
    if not names:
        return spark.createDataFrame([], "table_name string")
    return empty_tables(spark, {n: f"{folder.rstrip('/')}/{n}.parquet" for n in names})
