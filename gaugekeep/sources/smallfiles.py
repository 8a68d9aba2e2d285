"""Raw station files in great numbers on a (shared) disk (S3).

A Spark reader lists the files it is given once more in the driver and sets up a
Hadoop record reader for each, twice with rawlines' two passes; for files of a
few lines that is nearly all of the time. Here the folders are listed and the
files opened by the tasks themselves, from a table of paths that never passes
through the driver. A file is read in chunks of whole lines, its header (line 10)
beside each, so one pass gives the lines as rawlines does. Only files up to
WHOLE_BYTES are read so, as one task reads a file; larger ones, compressed ones,
those on other file systems and less than MANY_FILES go to rawlines, which cuts them
into splits.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from fnmatch import fnmatchcase
from itertools import islice
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugekeep.columns import STATION
from gaugekeep.functions.names import variable_name
from gaugekeep.sources.rawfiles import HEADER_INFO, HEADER_LINE, resolve_header
from gaugekeep.sources.rawlines import may_be_header, read_raw_lines, stored

MANY_FILES = 100
WHOLE_BYTES = 32 << 20
CHUNK_BYTES = 1 << 20
BATCH_FILES = 256
FILES_A_TASK = 5000
TASK_BYTES = 128 << 20
URL = "file:"
_COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"


def local_folder(root: str) -> str | None:
    """The path of a folder on a (shared) disk, None for other file systems."""
    url = urlsplit(root)
    return (root if not url.scheme else unquote(url.path) if url.scheme == "file" and not url.netloc else None)


def on_disk(spark: SparkSession, root: str) -> str | None:
    """As local_folder, where a path without a scheme stands for the disk, too."""
    if not urlsplit(root).scheme and not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:").startswith("file:"):
        return None
    return local_folder(root)


def _visible(name: str) -> bool:
    """What Spark's readers do not skip."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _matches(folder: str, parts: list[str]):
    """Entries that match the parts of a pattern, one for each level."""
    try:
        entries = os.scandir(folder)
    except NotADirectoryError:
        return
    with entries:
        for e in entries:
            if not _visible(e.name) or not fnmatchcase(e.name, parts[0]):
                continue
            if len(parts) > 1:
                if e.is_dir():
                    yield from _matches(e.path, parts[1:])
            elif e.is_file():
                yield e


def _listed(batches, parts: list[str]):
    """path, size and time of change (in ms, as Java tells it) of the files below folders."""

    def found():
        for b in batches:
            for folder in b.column(0).to_pylist():
                for e in _matches(folder, parts):
                    s = e.stat()
                    if s.st_size:
                        yield URL + e.path, s.st_size, s.st_mtime_ns // 1_000_000 * 1000

    rows = found()
    while some := list(islice(rows, 10_000)):
        path, size, modified = zip(*some, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(path, pa.string()), pa.array(size, pa.int64()), pa.array(modified, pa.int64()).cast(pa.timestamp("us", "UTC"))],
            ["path", "size", "modified"])


def list_by_tasks(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, size, modified of the files below `folder`; the driver reads the names of its
    first level alone. Stored, so that all that follows sees one state."""
    first, *rest = pattern.split("/")
    folder = os.path.abspath(folder)
    with os.scandir(folder) as entries:
        tops = [(e.path,) for e in entries if _visible(e.name) and fnmatchcase(e.name, first) and e.is_dir()]
    slices = max(1, min(len(tops), 8 * spark.sparkContext.defaultParallelism))
    tops = spark.createDataFrame(tops, "path string").repartition(slices)
    return stored(tops.mapInArrow(lambda b: _listed(b, rest), "path string, size bigint, modified timestamp"), "raw-listing")


def _header(lines: list[bytes]) -> bytes | None:
    return lines[HEADER_LINE - 1] if len(lines) >= HEADER_LINE else None


def _line(raw: bytes) -> bytes:
    return raw.removesuffix(b"\n").removesuffix(b"\r")


def _chunks(path: str, size: int):
    """(first line's number, header, lines joined by line feeds) over a file."""
    with open(path, "rb") as f:
        data = f.read(size)
        if data and len(data) < size and b"\r" not in data:  # the whole file as it stands
            text = data.removeprefix(b"\xef\xbb\xbf").removesuffix(b"\n")
            yield 1, _header(text.split(b"\n", HEADER_LINE)), text
            return
        f.seek(0)
        first, header = 1, None
        while lines := f.readlines(size):
            if first == 1:
                lines[0] = lines[0].removeprefix(b"\xef\xbb\xbf")
                lines += islice(f, max(0, HEADER_LINE - len(lines)))
                header = _header([_line(x) for x in lines[:HEADER_LINE]])
            yield first, header, b"\n".join(map(_line, lines))
            first += len(lines)


def _head(path: str, _):
    """As _chunks, for the header alone."""
    with open(path, "rb") as f:
        lines = [_line(x) for x in islice(f, HEADER_LINE)]
    yield 1, _header(lines), b""


def _read(batches, parts, chunk: int):
    rows, size = [], 0

    def out():
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
            ["path", "first_line", "header", "text"])

    for b in batches:
        for path in b.column(0).to_pylist():
            for row in parts(path.removeprefix(URL), chunk):
                rows.append((path, *row))
                size += len(row[-1])
                if size >= chunk or len(rows) >= BATCH_FILES:
                    yield out()
                    rows, size = [], 0
    if rows:
        yield out()


def _files(paths: DataFrame, parts, name) -> DataFrame:
    """Rows of `parts` for files, named, with the line that may be their header."""
    chunk = CHUNK_BYTES
    rows = paths.mapInArrow(lambda b: _read(b, parts, chunk), "path string, first_line int, header binary, text binary")
    header = F.col("header").cast("string")
    rows = rows.select((name(F.col("path")) if name else F.col("path")).alias("file_path"), "first_line",
                       F.when(may_be_header(header), header).alias("header"), F.col("text").cast("string").alias("text"))
    cells = F.split(F.col("file_path"), "/")
    return rows.withColumn(STATION, F.try_element_at(cells, F.lit(-2))).withColumn("file_name", F.element_at(cells, -1))


def _unread(paths: DataFrame, name) -> DataFrame:
    """Stations of files whose header does not resolve; of equal headers one is resolved."""
    heads = stored(_files(paths, _head, name).select(STATION, "header"), "raw-heads")
    bad = resolve_header(heads.select(F.col("header").alias("bad")).distinct(), "bad", ["bad"]).filter(~F.col("header_ok"))
    return heads.join(bad.select("bad"), F.col("header").eqNullSafe(F.col("bad")), "left_semi").select(STATION)


def literal_paths(listing: DataFrame) -> list[str]:
    """The paths for a reader: characters of glob patterns stand for themselves.
    They pass through the driver, which holds Spark's listing of them anyway."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", r.path) for r in listing.select("path").collect()]


class Listed:
    """A listing (path, size) as it was when asked for, and the number of its files."""

    def __init__(self, listing: DataFrame):
        self.files = stored(listing.select("path", "size"), "raw-paths")
        self._n = self.files.count()

    def __len__(self) -> int:
        return self._n


def read_listed_lines(spark: SparkSession, listed: Listed, name: Callable[[Column], Column] | None = None,
                      whole_stations: bool = False) -> DataFrame:
    """The table of read_raw_lines for listed files: small ones on a disk are read by the
    tasks, others with read_raw_lines."""
    listing = listed.files
    small = (F.col("path").startswith(URL + "/") & (F.col("size") <= WHOLE_BYTES)
             & ~F.lower("path").rlike(_COMPRESSED) & F.lit(on_disk(spark, URL + "/") is not None))
    n_small, size = listing.agg(F.count_if(small), F.sum(F.when(small, F.col("size")))).first()
    if n_small < MANY_FILES:
        return read_raw_lines(spark, literal_paths(listing), name, whole_stations)
    tasks = max(-(-n_small // FILES_A_TASK), -(-size // TASK_BYTES), min(n_small, 2 * spark.sparkContext.defaultParallelism))
    paths = listing.filter(small).select("path").repartition(tasks, "path")
    base = ["file_path", STATION, "file_name"]
    rows = resolve_header(_files(paths, _chunks, name), "header", [*base, "first_line", "text"])
    rows = rows.withColumn("variable", variable_name("file_name"))
    numbered = F.posexplode(F.split("text", "\n")).alias("__i", "__line")
    rows = rows.select(*base, "variable", *HEADER_INFO, "first_line", numbered)
    number = F.col("first_line") + F.col("__i")
    data = (number > HEADER_LINE) & (F.trim("__line") != "")
    rows = rows.select(*base, "variable", *HEADER_INFO[:2], F.when(data, 1).otherwise(0).alias("n_rows"), *HEADER_INFO[2:],
                       F.when(data, number).alias("line_no"), F.when(data, F.col("__line")).alias("line"))
    large = read_raw_lines(spark, literal_paths(listing.filter(~small)), name) if len(listed) > n_small else None
    table = rows if large is None else rows.unionByName(large)
    if not whole_stations:
        return table
    unread = _unread(paths, name)
    if large is not None:
        unread = unread.unionByName(large.filter(~F.col("header_ok")).select(STATION))
    unread = stored(unread.distinct(), "raw-unread").withColumnRenamed(STATION, "__s").withColumn("__unread", F.lit(True))
    table = table.join(unread, F.col(STATION).eqNullSafe(F.col("__s")), "left")
    return table.withColumn("header_ok", F.col("header_ok") & F.col("__unread").isNull()).drop("__s", "__unread")
