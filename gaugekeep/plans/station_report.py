"""What was extracted per station and which stations failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, STATION

from gaugekeep.operators.reports import coverage, extraction_summary, problem_stations
from gaugekeep.operators.stations import active_stations, sample_stations
from gaugekeep.sources.rawfiles import raw_file_stats, raw_file_table, raw_readings


def stations_to_fetch(stations: DataFrame, sample: int | None = None, seed: int = 0) -> DataFrame:
    """P1 + L1: the stations a run asks for."""
    return sample_stations(active_stations(stations), sample, seed)


def station_report(stations: DataFrame, files: DataFrame, download_log: DataFrame | None = None,
                   sample: int | None = None, seed: int = 0) -> dict[str, DataFrame]:
    """`files`: (file_path, text). Returns problem_stations,
    extraction_summary, coverage and unreadable_rows (per file, the data
    lines whose reading time could not be read; the masters skip them)."""
    asked = stations_to_fetch(stations, sample, seed)
    table = raw_file_table(files)
    return report_of_stats(asked, raw_file_stats(table), download_log) | {"unreadable_rows": unreadable_rows(table, asked)}


def report_of_stats(asked: DataFrame, stats: DataFrame, download_log: DataFrame | None = None) -> dict[str, DataFrame]:
    """The reports that need one row per file only (raw_file_stats, or the stored
    file table that refresh_file_table keeps)."""
    summary = extraction_summary(stats, asked)
    return {
        "problem_stations": problem_stations(asked, stats, download_log),
        "extraction_summary": summary,
        "coverage": coverage(asked, summary),
    }


def unreadable_rows(table: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Per file of the asked stations: the number of data lines without a
    readable reading time (partial counts per task, then one shuffle of
    one row per file)."""
    rd = raw_readings(table).filter(F.col(DATE).isNull())
    if stations is not None:
        rd = rd.join(stations.select(STATION), STATION, "left_semi")
    return rd.groupBy(F.col(STATION).alias("station_id"), "file_name").agg(F.count(F.lit(1)).alias("n_unreadable"))


def run_station_report(stations: DataFrame, files: DataFrame, out: str,
                       download_log: DataFrame | None = None, sample: int | None = None, seed: int = 0) -> None:
    """K3: the three reports as CSV folders under `out`."""
    from gaugekeep.sinks.files import write_csv
    for name, df in station_report(stations, files, download_log, sample, seed).items():
        write_csv(df, f"{out.rstrip('/')}/{name}")
