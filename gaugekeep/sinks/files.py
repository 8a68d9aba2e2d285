"""File sinks: CSV tables (K3) and the text status report (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugekeep.sources.csvfiles import TIME_FORMAT


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """K3: CSV with a header row and `NA` for missing cells (what the
    master reader S4 expects). Dates print as yyyy-MM-dd, civil times as the
    status reader S7 expects them."""
    w = (df.write.mode(mode).option("header", "true").option("nullValue", "NA").option("dateFormat", "yyyy-MM-dd")
         .option("timestampNTZFormat", TIME_FORMAT))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def write_report(report: DataFrame, path: str, col: str = "report") -> None:
    """K5: a one-row, one-column report written as text (a single file)."""
    report.select(col).coalesce(1).write.mode("overwrite").text(path)
