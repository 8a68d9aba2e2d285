"""What is known of every raw file (C5/A4), kept between runs: path, size, time of
change, number of data rows, whether its header resolves.

A run lists the folder (no byte of a file is read), keeps the rows of files whose
size and time of change are as stored, and parses only the others. The table
follows the folder: files that are gone lose their row. One commit replaces it."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.columns import STATION
from gaugekeep.functions.names import variable_name
from gaugekeep.session import small_files_session
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources.rawfiles import decode_path, raw_file_stats
from gaugekeep.sources.smallfiles import Listed, list_by_tasks, literal_paths, on_disk  # noqa: F401
from gaugekeep.sources.smallfiles import read_listed_lines as read_raw_lines

FILES = "raw_files"
_GLOB = r"[\\{}\[\]*?]"
SEEN = ("path", "size", "modified")
FILE_COLUMNS = (*SEEN, STATION, "file_name", "variable", "n_rows", "header_ok")


def list_raw_files(spark: SparkSession, root: str, pattern: str = "*/*.csv") -> DataFrame:
    """path, size and time of change of the raw files: on a disk listed by tasks, else by
    the binaryFile source, whose content column is not selected, so no file is opened.
    Spark's readers skip files of no byte, so such a file counts as absent, here as in the masters."""
    folder, levels = on_disk(spark, root), pattern.split("/")
    if folder and len(levels) > 1 and not re.search(_GLOB, root) and not re.search(_GLOB, pattern.replace("*", "")):
        return list_by_tasks(spark, folder, pattern)
    m = F.col("_metadata")
    reader = small_files_session(spark).read.format("binaryFile")
    root, (*folders, last) = root.rstrip("/"), pattern.split("/")
    path = urlsplit(root).path
    # a listing by folder is spread over tasks, a pattern is looked up by the driver alone
    plain = path.startswith("/") and not re.search(_GLOB, root) and all(f == "*" or not re.search(_GLOB, f) for f in folders)
    if plain:
        files = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", last).load(root)
    else:
        files = reader.load(f"{root}/{pattern}")
    files = files.select(decode_path(m["file_path"]).alias("path"), m["file_size"].alias("size"), m["file_modification_time"].alias("modified"))
    if plain:
        below = "".join("/[^/]+" if f == "*" else f"/{re.escape(f)}" for f in folders)
        files = files.filter(F.col("path").rlike(f"^([^/:]+:(//[^/]*)?)?{re.escape(path)}{below}/[^/]+$"))
    return files


def file_stats(spark: SparkSession, listing: DataFrame, name=None) -> DataFrame:
    """FILE_COLUMNS of the listed files, which are parsed. `name`: see read_raw_lines; it gives
    different files different names."""
    path = F.col("path")
    parts = F.split(F.col("file_path"), "/")
    listed = listing.select(*SEEN, (name(path) if name else path).alias("file_path"))
    listed = listed.select(*SEEN, F.try_element_at(parts, F.lit(-2)).alias(STATION), F.element_at(parts, -1).alias("file_name"), "file_path")
    listed = listed.withColumn("variable", variable_name("file_name"))
    files = Listed(listing)
    if not len(files):
        return listed.select(*listed.columns[:-2], "variable", F.lit(0).alias("n_rows"), F.lit(False).alias("header_ok"))
    read = raw_file_stats(read_raw_lines(spark, files, name), "file_path").select("file_path", "n_rows", "header_ok")
    return listed.join(read, "file_path", "left").select(
        *SEEN, STATION, "file_name", "variable", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("header_ok", F.lit(False)).alias("header_ok"))


def _as_seen(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in SEEN]
    return a.join(b.select(*[F.col(c).alias(f"__{c}") for c in SEEN]), reduce(lambda x, y: x & y, same), how)


def refresh_file_table(store: TableStore, root: str, pattern: str = "*/*.csv", name=None) -> int:
    """Bring the stored table up to the folder's state; returns the number of files
    parsed. Nothing is written if the folder is as stored."""
    base = store.snapshot()
    listing = list_raw_files(store.spark, root, pattern)
    if FILES not in base.tables:
        with store.transaction(base) as t:
            t.replace(FILES, file_stats(store.spark, listing, name))
        return listing.count()
    known = base.read(FILES)
    changed = _as_seen(listing, known, "left_anti")
    n_changed = changed.count()
    kept = _as_seen(known, listing, "left_semi")
    if n_changed or kept.count() < known.count():
        rows = kept.select(*FILE_COLUMNS)
        if n_changed:
            rows = rows.unionByName(file_stats(store.spark, changed, name))
        with store.transaction(base) as t:
            t.replace(FILES, rows)
    return n_changed
