"""Stored tables with one commit log (K1, K2, K4).

Layout:
  <root>/<table>/<write>/year=YYYY/*.parquet   the files of one write, by year of `Date`
  <root>/_commits/<NNNNNNNN>.json              what all tables consist of after commit N

A commit names, for every table, its schema and the year folders it consists of,
each of them from the write that made it. So replacing the rows of some years
(replace_years) or adding rows (append) writes only those; the other years' files
are named again, not written again. Files become part of a table only when a commit
names them: one commit may change several tables, and a reader sees all of its
changes or none. A job that fails before its commit leaves nothing but unnamed
folders (removed by drop_versions).

A transaction is based on the snapshot it started from and commits the number after
it; if another commit took that number, it fails with CommitConflict and changes
nothing. The commit file is written aside and renamed without overwriting.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugekeep.columns import DATE

YEAR = "year"
COMMITS = "_commits"
ALL = ""  # the one folder of a table without days


class CommitConflict(RuntimeError):
    """Another commit came between a transaction's snapshot and its own."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(self._conf)

    # -- commits -------------------------------------------------------
    def _names(self, folder: str, dirs: bool) -> list[str]:
        p = self._Path(f"{self.root}/{folder}")
        if not self._fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p) if s.isDirectory() == dirs)

    def versions(self) -> list[int]:
        """Numbers of the commits, rising."""
        return [int(n[:-5]) for n in self._names(COMMITS, False) if n.endswith(".json") and n[:-5].isdigit()]

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/{COMMITS}/{number:08d}.json"

    def snapshot(self, number: int | None = None) -> Snapshot:
        """All tables as of commit `number` (default: the newest one)."""
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return Snapshot(self, 0, {})
        stream = self._fs.open(self._Path(self._commit_path(number)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(self, number, json.loads(text)["tables"])

    def _publish(self, number: int, tables: dict) -> None:
        aside = self._Path(f"{self.root}/{COMMITS}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps({"tables": tables}).encode("utf-8")))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        target = self._Path(self._commit_path(number))
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(target), no_options)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(target):
                raise CommitConflict(f"commit {number} of {self.root} exists already") from e
            raise

    # -- reads ---------------------------------------------------------
    def read(self, table: str, keep_year: bool = False) -> DataFrame:
        """The newest committed state of a table (see Snapshot.read)."""
        return self.snapshot().read(table, keep_year)

    def exists(self, table: str) -> bool:
        return table in self.snapshot().tables

    def tables(self) -> list[str]:
        return sorted(self.snapshot().tables)

    # -- writes --------------------------------------------------------
    def transaction(self, base: Snapshot | None = None) -> Transaction:
        """Changes to any tables that one commit makes visible together."""
        return Transaction(self, base or self.snapshot())

    def replace(self, table: str, df: DataFrame, dealt: bool = False) -> int:
        """K1 with a commit of its own; returns its number."""
        with self.transaction() as t:
            t.replace(table, df, dealt)
        return t.number

    def append(self, table: str, df: DataFrame) -> int:
        """K2 with a commit of its own; returns its number."""
        with self.transaction() as t:
            t.append(table, df)
        return t.number

    def compact(self, table: str, files_per_year: int | None = None) -> int:
        """Write the table anew (appends, e.g. one per micro-batch, leave many
        small files); `files_per_year` bounds the files written per year."""
        base = self.snapshot()
        df = base.read(table, keep_year=True)
        dealt = bool(files_per_year) and YEAR in df.columns
        if dealt:
            # one task per (year, bucket) at most, as many tasks as the session's shuffle partitions
            df = df.repartition(YEAR, F.pmod(F.xxhash64(df.columns[0]), F.lit(files_per_year)))
        with self.transaction(base) as t:
            t.replace(table, df if dealt else df.drop(YEAR), dealt)
        return t.number

    def drop_versions(self, *tables: str, keep: int = 1) -> None:
        """Forget all but the newest `keep` commits and remove the folders of
        `tables` (default: all) that none of them names, also those of writes
        that were never committed; not while another job writes."""
        numbers = self.versions()
        for n in numbers[:-keep]:
            self._fs.delete(self._Path(self._commit_path(n)), False)
        kept = [self.snapshot(n).tables for n in numbers[-keep:]]
        for table in tables or [d for d in self._names("", True) if d != COMMITS]:
            named = {f.split("/")[1] for state in kept for fs in state.get(table, {"folders": {}})["folders"].values() for f in fs}
            for write in self._names(table, True):
                if write not in named:
                    self._fs.delete(self._Path(f"{self.root}/{table}/{write}"), True)
        for table in tables:
            if not any(table in state for state in kept):
                self._fs.delete(self._Path(f"{self.root}/{table}"), True)

    def reset(self, tables) -> None:
        """K4: drop the given tables entirely."""
        with self.transaction() as t:
            for table in tables:
                t.drop(table)
        self.drop_versions(*tables)


class Snapshot:
    """What the tables consist of after one commit."""

    def __init__(self, store: TableStore, number: int, tables: dict):
        self.store, self.number, self.tables = store, number, tables

    def schema(self, table: str) -> StructType:
        if table not in self.tables:
            raise FileNotFoundError(f"table {table!r} does not exist under {self.store.root}")
        return StructType.fromJson(json.loads(self.tables[table]["schema"]))

    def folders(self, table: str) -> dict[str, list[str]]:
        """Year folder name -> the folders (of several writes) that hold it."""
        return self.tables[table]["folders"]

    def read(self, table: str, keep_year: bool = False, years: list[int] | None = None) -> DataFrame:
        """`keep_year` keeps the partition column, so that a later day filter can
        prune on it (see stored_since); `years` reads these years' folders only
        (None in the list: rows without a day). An empty table reads as an empty
        DataFrame; a column that an older write lacks is null."""
        schema = self.schema(table)
        names = None if years is None else {year_folder(y) for y in years}
        by_write: dict[str, list[str]] = {}
        for name, paths in self.folders(table).items():
            if names is None or name in names:
                for p in paths:
                    by_write.setdefault("/".join(p.split("/")[:2]), []).append(p)
        root, spark = self.store.root, self.store.spark
        parts = [spark.read.schema(schema).option("basePath", f"{root}/{write}").parquet(*[f"{root}/{p}" for p in sorted(paths)])
                 for write, paths in sorted(by_write.items())]
        df = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
        return df if keep_year or YEAR not in schema.fieldNames() or DATE not in schema.fieldNames() else df.drop(YEAR)


def year_folder(year: int | None) -> str:
    return f"{YEAR}={'__HIVE_DEFAULT_PARTITION__' if year is None else year}"


class Transaction:
    """Writes files at once; the commit at its end (or at the end of the `with`
    block, unless it raised) makes them part of the tables."""

    def __init__(self, store: TableStore, base: Snapshot):
        self.store, self.base, self.number = store, base, base.number
        self._tables = dict(base.tables)

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()

    def commit(self) -> int:
        """The number of the commit (the base's, if nothing changed)."""
        if self._tables != self.base.tables:
            self.store._publish(self.base.number + 1, self._tables)
            self.number = self.base.number + 1
        return self.number

    def _write(self, table: str, df: DataFrame, dealt: bool = False) -> tuple[StructType, dict[str, list[str]]]:
        """Schema and folders of the files of `df`. Rows of a year lie together
        (AQE splits large years), so that files follow the data's size, not the
        number of tasks; `dealt`: they do already."""
        write = f"{table}/{self.base.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.store.root}/{write}"
        if DATE not in df.columns:
            df.write.mode("errorifexists").parquet(path)
            return df.schema, {ALL: [write]}
        if not dealt:
            df = df.withColumn(YEAR, F.year(F.col(DATE))).hint("rebalance", YEAR)
        df.write.mode("errorifexists").partitionBy(YEAR).parquet(path)
        return df.schema, {n: [f"{write}/{n}"] for n in self.store._names(write, True) if n.startswith(f"{YEAR}=")}

    def replace(self, table: str, df: DataFrame, dealt: bool = False) -> None:
        """K1: the table consists of `df`."""
        schema, folders = self._write(table, df, dealt)
        self._tables[table] = {"schema": schema.json(), "folders": folders}

    def replace_years(self, table: str, df: DataFrame, years: list[int | None]) -> None:
        """The rows of `years` are those of `df`, which holds no others; the files
        of the other years stay as they are. `df` may bring columns that the table
        lacks (null in the other years)."""
        old = self._schema(table)
        for f in df.schema:
            if f.name in old.fieldNames() and old[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name!r} of table {table!r} is {old[f.name].dataType.simpleString()}")
        _, written = self._write(table, df)
        gone = {year_folder(y) for y in years}
        if set(written) - gone:
            raise ValueError(f"rows of years that are not to be replaced: {sorted(set(written) - gone)}")
        have = self._tables[table]["folders"]
        fields = [f for f in old if f.name != YEAR] + [f for f in df.schema if f.name not in old.fieldNames()]
        schema = StructType([*fields, old[YEAR]])
        self._tables[table] = {"schema": schema.json(), "folders": {n: p for n, p in have.items() if n not in gone} | written}

    def append(self, table: str, df: DataFrame) -> None:
        """K2: add rows. Columns the stored table has and `df` lacks become NULL; a
        column the table lacks is an error. A table that doesn't exist is made."""
        if table not in self._tables:
            return self.replace(table, df)
        fields = [f for f in self._schema(table) if not (f.name == YEAR and DATE in df.columns)]
        extra = [c for c in df.columns if c not in {f.name for f in fields}]
        if extra:
            raise ValueError(f"columns {extra} do not exist in table {table!r}")
        aligned = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        _, written = self._write(table, aligned)
        have = self._tables[table]["folders"]
        self._tables[table] = self._tables[table] | {
            "folders": {n: have.get(n, []) + written.get(n, []) for n in sorted({*have, *written})}}

    def drop(self, table: str) -> None:
        self._tables.pop(table, None)

    def _schema(self, table: str) -> StructType:
        return Snapshot(self.store, self.number, self._tables).schema(table)
