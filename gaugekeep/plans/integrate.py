"""Fold a new publication into the stored tables.

Result = every published row + every stored row the publication does not
cover (by station, day, parameter). Stored rows keep their pub_status, also
Published rows the new release no longer holds, unless `drop_retracted`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.columns import DATE, DAY_PARAM_KEYS, PARAMETER, PUB_STATUS, PUBLISHED
from gaugekeep.operators.merge import stack, unaffected_rows
from gaugekeep.plans.reset import TABLES
from gaugekeep.sinks.snapshots import TableStore, Transaction


def integrate_publication(publication: DataFrame, stored: DataFrame, keys=DAY_PARAM_KEYS,
                          drop_retracted: bool = False) -> DataFrame:
    pub = publication.withColumn(PUB_STATUS, F.lit(PUBLISHED))
    kept = unaffected_rows(stored, pub, keys)
    if drop_retracted:
        kept = kept.filter(~F.col(PUB_STATUS).eqNullSafe(F.lit(PUBLISHED)))
    return stack(pub, kept)


def _row_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per year of Date: count and two sums of hashes of the rows (a missing
    column is null). One row per year and task is shuffled."""
    cells = [x for c in columns for v in [F.col(c) if c in df.columns else F.lit(None)] for x in (v, v.isNull())]
    wide = "decimal(38,0)"
    return df.groupBy(F.year(DATE).alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cells).cast(wide)).alias("h1"),
        F.sum(F.xxhash64(F.lit(7), *cells).cast(wide)).alias("h2"))


def changed_years(pub: DataFrame, stored: DataFrame, keys=DAY_PARAM_KEYS) -> list[int | None]:
    """Years in which integrate_publication(pub, stored) differs from `stored`
    (None: rows without a day): those whose published rows are not the stored
    published rows, and those in which a stored row that isn't published is covered.

    The rows are compared by count and two sums of 64-bit hashes, in the tasks that
    read them; only the stored rows that aren't published are joined."""
    columns = [c for c in stored.columns if c != "year"]
    if set(pub.columns) - set(columns):
        years = pub.select(F.year(DATE).alias("y")).union(stored.select(F.year(DATE).alias("y")))
        return sorted((r.y for r in years.distinct().collect()), key=lambda y: (y is None, y))
    published = F.col(PUB_STATUS).eqNullSafe(F.lit(PUBLISHED))
    new = _row_digest(pub, columns).select(F.col("y").alias("py"), F.struct("n", "h1", "h2").alias("p"))
    old = _row_digest(stored.filter(published), columns).select("y", F.struct("n", "h1", "h2").alias("s"))
    # stored published rows of a year without publication rows stay, so such a year doesn't change
    differ = new.join(old, new.py.eqNullSafe(old.y), "left").filter(~F.col("p").eqNullSafe(F.col("s"))).select(F.col("py").alias("y"))
    covered = pub.select(*keys).join(
        stored.filter(~published).select(*[F.col(k).alias(f"__s_{k}") for k in keys]),
        reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]), "left_semi").select(F.year(DATE).alias("y"))
    return sorted((r.y for r in differ.union(covered).distinct().collect()), key=lambda y: (y is None, y))


def integrate_years(t: Transaction, table: str, pub: DataFrame, drop_retracted: bool = False) -> list[int | None] | None:
    """C2 on one stored table, by copy on write: only the years that the publication
    changes are read and written. Returns them (None: the table was made anew)."""
    pub = pub.withColumn(PUB_STATUS, F.lit(PUBLISHED))
    if table not in t.base.tables or drop_retracted:
        # a retracted row may stand in any year
        stored = t.base.read(table) if table in t.base.tables else None
        t.replace(table, integrate_publication(pub, stored, drop_retracted=drop_retracted) if stored is not None else pub)
        return None
    years = changed_years(pub, t.base.read(table))
    if years:
        of = F.year(DATE)
        keep = F.lit(False) if None not in years else of.isNull()
        here = pub.filter(keep | F.coalesce(of.isin([y for y in years if y is not None]), F.lit(False)))
        t.replace_years(table, integrate_publication(here, t.base.read(table, years=years)), years)
    return years


def run_integrate(store: TableStore, publication: DataFrame, station_meta: DataFrame | None = None,
                  drop_retracted: bool = False, also: dict[str, DataFrame] | None = None) -> dict:
    """One commit for flow, level, the station metadata and the tables of `also`
    (replaced); never overwrites files that a reader may hold. Returns the years
    written of flow and level."""
    with store.transaction() as t:
        for name, df in ({"station_metadata": station_meta} | (also or {})).items():
            if df is not None:
                t.replace(name, df)
        return {table: integrate_years(t, table, publication.filter(F.col(PARAMETER) == param), drop_retracted)
                for table, param in TABLES.items()}
