"""Full reset of the stored tables from the published archive.
Unpublished rows are lost, as in the reference job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import FLOW, LEVEL, PARAMETER, PUB_STATUS, PUBLISHED
from gaugekeep.sinks.snapshots import TableStore

TABLES = {"flow": FLOW, "level": LEVEL}


def reset_tables(publication: DataFrame) -> DataFrame:
    """Rows of the rebuilt flow and level tables, tagged Published."""
    return (publication.filter(F.col(PARAMETER).isin(*TABLES.values()))
            .withColumn(PUB_STATUS, F.lit(PUBLISHED)))


def run_reset(store: TableStore, publication: DataFrame, station_meta: DataFrame | None = None) -> int:
    """K1 + K4: fresh tables in one commit, then the older ones are removed. A
    failed write leaves the tables as they were. Returns the commit's number."""
    rows = reset_tables(publication)
    with store.transaction() as t:
        for table, p in TABLES.items():
            t.replace(table, rows.filter(F.col(PARAMETER) == p))
        if station_meta is not None:
            t.replace("station_metadata", station_meta)
    store.drop_versions(keep=1)
    return t.number
