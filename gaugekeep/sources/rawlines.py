"""Raw station files of any size, line by line (S3).

Spark splits a large file over many tasks, so a line's number and the header of
its file (line 10) are not known where the line is read. Two passes find them,
and the lines themselves are never shuffled or gathered:

1. Over the splits: per file and split the number of lines and the row id of the
   first one. The same hash aggregate keeps the few lines that can be a header
   at all (as a grouping key), with the smallest row id for each of ten remainders
   of the id: the first ten lines of a split have different remainders, so these
   ids tell exactly at which of them a text stands. Running sums over a file's
   splits then give each split's first line number, and with it the header.
2. Over the lines: the split's row (file, split, first line, header positions) is
   joined on, a broadcast where Spark measures the table of splits as small enough
   (it is stored, so its size is known), else a join by file and split.

Row ids are monotonically_increasing_id, which are consecutive within a split. Both
passes have to cut the files alike: the second checks that every id lies within
its split's range, which holds for all lines only then, and fails otherwise. On a
cluster whose number of cores changes, set spark.sql.files.minPartitionNum (see
cluster_conf), so that the cuts don't depend on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugekeep.columns import STATION
from gaugekeep.functions.columns import RESOLVE_SPEC
from gaugekeep.functions.names import variable_name
from gaugekeep.session import scratch_dir, small_files_session
from gaugekeep.sources.rawfiles import HEADER_INFO, HEADER_LINE, decode_path, resolve_header

FILE, SPLIT, ROW = "__file", "__split", "__row"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], f"{FILE} string, {SPLIT} bigint, {ROW} bigint, line string")
    line = F.col("value")
    line = F.when(line.endswith("\r"), line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)
    if not isinstance(paths, str):
        spark = small_files_session(spark)
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(ROW), line.alias("line"))


def may_be_header(line: Column) -> Column:
    """A header that resolves holds the fragments of the two columns that must
    exist once and, letter by letter, the name of the third."""
    low = F.lower(line)
    need = [low.contains(frag) if frag else line.contains(name) for name, frag in RESOLVE_SPEC[:3]]
    return need[1] & need[0] & need[2]  # the cheap test first: few data lines pass it


def _splits(lines: DataFrame) -> DataFrame:
    """Pass 1: one row per split: its lines' count, first row id, first line
    number and the header line of its file (null: none that resolves)."""
    text = F.when(may_be_header(F.col("line")), F.col("line")).alias("text")
    at = [F.min(F.when(F.col(ROW) % HEADER_LINE == r, F.col(ROW))).alias(f"at{r}") for r in range(HEADER_LINE)]
    found = lines.groupBy(FILE, SPLIT, text).agg(F.count(F.lit(1)).alias("n"), F.min(ROW).alias("base"), *at)
    found = stored(found, "raw-splits")
    before = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = found.groupBy(FILE, SPLIT).agg(F.sum("n").alias("n"), F.min("base").alias("base"))
    splits = splits.withColumn("first_line", F.lit(1) + F.coalesce(F.sum("n").over(before), F.lit(0)))
    # the split that holds the header line: the row id that it must have
    place = F.lit(HEADER_LINE) - F.col("first_line")
    holds = splits.filter((place >= 0) & (place < F.col("n"))).select(
        F.col(FILE).alias("__f"), F.col(SPLIT).alias("__s"), (F.col("base") + place).alias("__row"))
    ids = F.array(*[F.col(f"at{r}") for r in range(HEADER_LINE)])
    heads = found.filter(F.col("text").isNotNull()).join(
        holds, (F.col(FILE) == F.col("__f")) & (F.col(SPLIT) == F.col("__s"))
        & (F.element_at(ids, (F.col("__row") % HEADER_LINE + 1).cast("int")) == F.col("__row")))
    heads = heads.select(F.col("__f"), F.col("text").alias("header"))
    return splits.join(heads, F.col(FILE) == F.col("__f"), "left").drop("__f")


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_raw_lines(spark: SparkSession, paths: str | list[str], name: Callable[[Column], Column] | None = None,
                   whole_stations: bool = False) -> DataFrame:
    """A table as raw_file_table gives it, but one row per line of the files `paths`
    (files or patterns): file_path, station, file name, variable, header_ok, header
    positions, and `line`, `line_no` and n_rows = 1 of a data line (after the
    header, not blank); for another line they are null and 0.

    `name` turns a path into `.../<station>/<heading>.csv` where files lie
    otherwise. `whole_stations`: header_ok holds only if the headers of all of the
    station's files among `paths` resolve (told by the small table of splits). Runs
    pass 1 at once."""
    lines = _lines(spark, paths)
    path = decode_path(F.col(FILE))
    parts = F.split(F.col("file_path"), "/")
    splits = _splits(lines).withColumn("file_path", name(path) if name else path)
    splits = splits.withColumn(STATION, F.try_element_at(parts, F.lit(-2))).withColumn("file_name", F.element_at(parts, -1))
    base = ["file_path", STATION, "file_name"]
    splits = resolve_header(splits, "header", [FILE, SPLIT, "n", "base", "first_line", *base])
    if whole_stations:
        splits = splits.withColumn("header_ok", F.bool_and("header_ok").over(Window.partitionBy(STATION)))
    splits = stored(splits.withColumn("variable", variable_name("file_name")), "raw-splits")

    known = splits.withColumnRenamed(FILE, "__f").withColumnRenamed(SPLIT, "__s")
    rows = lines.join(known, (F.col(FILE) == F.col("__f")) & (F.col(SPLIT) == F.col("__s")), "left")
    place = F.col(ROW) - F.col("base")
    number = F.when((place >= 0) & (place < F.col("n")), (F.col("first_line") + place).cast("int")).otherwise(
        F.raise_error(F.lit("files were cut otherwise in the two passes: spark.sql.files.* or the number of cores changed")).cast("int"))
    data = (F.col("line_no") > HEADER_LINE) & (F.trim("line") != "")
    return (rows.withColumn("line_no", number)
            .select(*base, "variable", *HEADER_INFO[:2], F.when(data, 1).otherwise(0).alias("n_rows"), *HEADER_INFO[2:],
                    F.when(data, F.col("line_no")).alias("line_no"), F.when(data, F.col("line")).alias("line")))
