"""Run reports: empty stations (A4), extraction summary (A5), coverage (A6),
problem stations (U2), missing and empty archive tables (U3, L3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.columns import ISSUE_ALL_EMPTY, ISSUE_FATAL, ISSUE_NO_LINKS, STATION


def _per_station(file_stats: DataFrame) -> DataFrame:
    """One row per station from one row per file (columns STATION_NUMBER,
    file_name, n_rows, header_ok)."""
    return file_stats.groupBy(STATION).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.max("n_rows").alias("max_rows"),
        F.bool_and("header_ok").alias("all_ok"),
        F.array_join(F.array_sort(F.collect_list("file_name")), ", ").alias("tables_extracted"),
    )


def empty_stations(file_stats: DataFrame) -> DataFrame:
    """A4: stations whose every file has no data row."""
    s = _per_station(file_stats)
    return s.filter(F.col("max_rows") == 0).select(STATION, "n_files")


def extraction_summary(file_stats: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """A5: per station that was processed, its file names in name order,
    joined by ', '. Stations with only empty files or with an unreadable file
    get no row. `stations` limits the report to the stations asked for.
    The list per station is bounded by the number of files of one station."""
    fs = file_stats if stations is None else file_stats.join(stations.select(STATION), STATION, "left_semi")
    s = _per_station(fs)
    done = s.filter((F.col("max_rows") > 0) & F.col("all_ok"))
    return done.select(F.col(STATION).alias("station_id"), "tables_extracted")


def coverage(stations: DataFrame, summary: DataFrame) -> DataFrame:
    """One row: stations asked for, stations done, per cent done
    (2 decimals, half to even)."""
    done = summary.select(F.col("station_id").alias(STATION), F.lit(1).alias("__done"))
    j = stations.select(STATION).join(done, STATION, "left")
    return j.agg(F.count(F.lit(1)).alias("n_stations"), F.count("__done").alias("n_done")).select(
        "n_stations", "n_done",
        F.bround(F.col("n_done") * F.lit(100.0) / F.col("n_stations"), 2).alias("coverage_pct"))


def problem_stations(stations: DataFrame, file_stats: DataFrame,
                     download_log: DataFrame | None = None) -> DataFrame:
    """U2 over the issues derivable from data: no file at all, only empty
    files, an unreadable file; plus rows of an optional download log
    (station_id, issue). Distinct rows."""
    s = _per_station(file_stats.join(stations.select(STATION), STATION, "left_semi"))
    j = stations.select(STATION).join(s, STATION, "left")
    issue = (F.when(F.col("n_files").isNull(), F.lit(ISSUE_NO_LINKS))
              .when(F.col("max_rows") == 0, F.lit(ISSUE_ALL_EMPTY))
              .when(~F.col("all_ok"), F.lit(ISSUE_FATAL)))
    out = j.select(F.col(STATION).alias("station_id"), issue.alias("issue")).filter(F.col("issue").isNotNull())
    if download_log is not None:
        out = out.unionByName(download_log.select("station_id", "issue"))
    return out.distinct()


def missing_tables(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected table names that are not present (EXCEPT DISTINCT)."""
    return expected.select("table_name").subtract(present.select("table_name"))


def list_tables(spark: SparkSession, folder: str, suffix: str = ".parquet") -> DataFrame:
    """Names of the tables in an archive folder (`<name>.parquet`, file or
    directory): its first level only, so a table of many part files is one
    entry of the listing."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(st.getPath().getName() for st in found)
    rows = [(n[:-len(suffix)],) for n in names if n.endswith(suffix) and n != suffix]
    return spark.createDataFrame(rows, "table_name string")


def views_with_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """L3: names of the tables holding at least one row; each probe takes
    at most one row of its table."""
    probes = [df.limit(1).select(F.lit(n).alias("table_name")) for n, df in tables.items()]
    return reduce(DataFrame.unionAll, probes)


def empty_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """L3: present tables without any row."""
    return empty_views(spark, {n: spark.read.parquet(p) for n, p in paths.items()})


def empty_views(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """L3 over DataFrames: names of those without any row."""
    names = spark.createDataFrame([(n,) for n in tables], "table_name string")
    return names.subtract(views_with_rows(tables))
