"""Raw station files (S3): `<root>/<station>/<heading>.csv`, 9 preamble
lines, a header on line 10 whose names vary by file, then one reading per line.

Plan shape: one row per file (or per chunk of a file), the header resolved
per row with array expressions, the data lines exploded with their line
number and split into cells once. No shuffle and no join: every file is
handled inside the task that reads it, files are spread over all tasks.
Files of any size are read line by line (rawlines).

CSV cells: RFC 4180 quoting (a quote inside a quoted cell is doubled), no
line breaks inside quotes. A line without a quote character is split on
commas; a quoted line on the commas outside quotes. Cells have no fixed
count, so a file may have any number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugekeep.columns import APPROVAL, DATE, GRADE, PARAMETER, RAW_PREAMBLE_LINES, STATION, VALUE
from gaugekeep.functions.columns import RESOLVE_SPEC
from gaugekeep.functions.names import variable_name

HEADER_LINE = RAW_PREAMBLE_LINES + 1
# a comma followed by an even number of quote characters up to the line end
_COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def split_csv_line(line: Column) -> Column:
    """Cells of one CSV line, quotes still in place (see unquote)."""
    return F.when(F.instr(line, '"') > 0, F.split(line, _COMMA_OUTSIDE_QUOTES)).otherwise(F.split(line, ","))


def unquote(cell: Column) -> Column:
    """Strip the quotes around a quoted cell and undouble the quotes inside
    it; unquoted cells are returned as they are."""
    n = F.length(cell)
    quoted = cell.startswith('"') & cell.endswith('"') & (n >= 2)
    return F.when(quoted, F.replace(cell.substr(F.lit(2), n - 2), F.lit('""'), F.lit('"'))).otherwise(cell)


def read_raw_files(spark: SparkSession, root: str, pattern: str = "*/*.csv") -> DataFrame:
    """One row per file: (file_path, text). `_metadata.file_path` is
    URL-encoded; '+' is protected before decoding so it is not read as a
    space."""
    df = spark.read.text(f"{root.rstrip('/')}/{pattern}", wholetext=True)
    return df.select(decode_path(F.col("_metadata.file_path")).alias("file_path"), F.col("value").alias("text"))


def read_raw_listing(spark: SparkSession, root: str, pattern: str = "*/*.csv") -> DataFrame:
    """The paths of the raw files only (binaryFile source: the content column
    is never read when it is not selected)."""
    df = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{pattern}")
    return df.select(decode_path(F.col("path")).alias("file_path"))


def decode_path(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def newest_files(listing: DataFrame, path_col: str = "file_path") -> DataFrame:
    """One row per (station, variable): the newest file name (last by name).
    Built from paths alone, so it costs a listing, not a read."""
    parts = F.split(F.col(path_col), "/")
    t = listing.select(F.try_element_at(parts, F.lit(-2)).alias(STATION), F.element_at(parts, -1).alias("file_name"))
    t = t.withColumn("variable", variable_name("file_name"))
    return t.groupBy(STATION, "variable").agg(F.max("file_name").alias("file_name"))


def newest_paths(listing: DataFrame, path_col: str = "file_path", name=None, keep=()) -> DataFrame:
    """D6 on the listing: the paths of the files that count (and the columns `keep`), so that
    no byte of a superseded one is read. `name`: see read_raw_lines."""
    path = F.col(path_col)
    files = listing.select(path.alias("path"), *keep, (name(path) if name else path).alias("file_path"))
    parts = F.split(F.col("file_path"), "/")
    files = files.select("path", *keep, F.try_element_at(parts, F.lit(-2)).alias(STATION), F.element_at(parts, -1).alias("file_name"))
    files = files.withColumn("variable", variable_name("file_name"))
    last = Window.partitionBy(STATION, "variable").orderBy(F.desc("file_name"))
    return files.withColumn("__k", F.rank().over(last)).filter("__k = 1").select("path", *keep)


def _indices(names: Column, pred) -> Column:
    """0-based positions of the header names matching `pred`."""
    return F.filter(F.transform(names, lambda c, i: F.when(pred(c), i)), lambda x: x.isNotNull())


def resolve_header(df: DataFrame, header_col: str, keep: list[str]) -> DataFrame:
    """Parse a header line once and resolve the positions of Date,
    Parameter, Value, Approval, Grade (RESOLVE_SPEC). Adds hdr, header_ok and
    i_<name> (0-based) to the columns in `keep`."""
    hdr = F.transform(split_csv_line(F.col(header_col)), lambda c: unquote(F.trim(c)))
    step = df.select(*keep, hdr.alias("hdr"))
    found = {}
    for target, frag in RESOLVE_SPEC:
        if frag is None:
            found[target] = _indices(F.col("hdr"), lambda c, t=target: c == F.lit(t))
        else:
            found[target] = _indices(F.col("hdr"), lambda c, f=frag: F.lower(c).contains(f))
    step = step.select(*keep, "hdr", *[ix.alias(f"__ix_{t}") for t, ix in found.items()])
    n = {t: F.size(f"__ix_{t}") for t in found}
    # of several Approval or Grade columns the first counts, the others are extra columns
    ok = (n[DATE] == 1) & (n[PARAMETER] >= 1) & (n[VALUE] == 1)
    return step.select(*keep, "hdr", F.coalesce(ok, F.lit(False)).alias("header_ok"),
                       *[F.try_element_at(F.col(f"__ix_{t}"), F.lit(1)).alias(f"i_{t}") for t in found])


HEADER_INFO = ["hdr", "header_ok"] + [f"i_{t}" for t, _ in RESOLVE_SPEC]


def _data_lines(lines: Column, first_line: Column) -> Column:
    """Numbered data lines (after the header), blank lines dropped."""
    numbered = F.transform(lines, lambda l, i: F.struct(l.alias("line"), (first_line + i).alias("line_no")))
    return F.filter(numbered, lambda x: (x["line_no"] > HEADER_LINE) & (F.trim(x["line"]) != ""))


def raw_file_table(files: DataFrame, path_col: str = "file_path", text_col: str = "text",
                   first_line_col: str = "first_line", header_col: str = "header") -> DataFrame:
    """Station (parent folder), file name, variable, resolved header
    positions, header_ok, number of data rows and the numbered data lines
    (blank lines dropped, as a CSV reader does).

    Whole files (no `first_line_col` column): one row per file; the text is
    split once and the header (line 10) parsed once per file.

    Chunked files (`first_line_col` and `header_col` present): each row holds
    consecutive lines of a file starting at line `first_line_col` (1-based)
    and carries the file's header line, so a file of any size is spread over
    bounded rows and every chunk is parsed on its own: no join, no shuffle.
    One row per chunk; raw_file_stats sums the chunks of a file.

    A table of lines (read_raw_lines) is returned as it is."""
    if "line" in files.columns:
        return files
    parts = F.split(F.col(path_col), "/")
    ident = [F.col(path_col).alias("file_path"), F.try_element_at(parts, F.lit(-2)).alias(STATION),
             F.element_at(parts, -1).alias("file_name")]
    base = ["file_path", STATION, "file_name"]
    lines = F.split(F.col(text_col), r"\r?\n").alias("__lines")
    if first_line_col in files.columns:
        step = files.select(*ident, F.col(first_line_col).cast("int").alias("__first"),
                            F.col(header_col).alias("__header"), lines)
        step = step.select(*base, "__header", _data_lines(F.col("__lines"), F.col("__first")).alias("lines"))
    else:
        step = files.select(*ident, lines)
        step = step.select(*base, F.try_element_at(F.col("__lines"), F.lit(HEADER_LINE)).alias("__header"),
                           _data_lines(F.col("__lines"), F.lit(1)).alias("lines"))
    step = resolve_header(step, "__header", base + ["lines"]).withColumn("variable", variable_name("file_name"))
    return step.select(*base, "variable", *HEADER_INFO[:2], F.size("lines").alias("n_rows"),
                       *HEADER_INFO[2:], "lines")


def raw_file_stats(table: DataFrame, *keep: str) -> DataFrame:
    """One row per file: [`keep`, e.g. file_path,] STATION_NUMBER, file_name,
    variable, n_rows, header_ok (chunks of one file are summed: one small row per
    chunk is shuffled)."""
    return (table.groupBy("file_path", STATION, "file_name", "variable", "header_ok")
            .agg(F.sum("n_rows").cast("int").alias("n_rows"))
            .select(*keep, STATION, "file_name", "variable", "n_rows", "header_ok"))


def _na(c: Column) -> Column:
    """Missing cell: empty (as the CSV parser reads it) or `NA`."""
    return F.when(~c.isin("NA", ""), c)


def parse_time(c: Column) -> Column:
    """Reading time as TIMESTAMP_NTZ. The NTZ cast ignores a trailing zone
    (`-08:00`, `Z`, `PST`), so the civil time of the station is kept without
    a shift. Unreadable text gives NULL."""
    return c.try_cast("timestamp_ntz")


def raw_readings(table: DataFrame, keep_extra: bool = False) -> DataFrame:
    """One row per data line of every readable file: STATION_NUMBER,
    variable, file_name, line_no, Date (reading time), Parameter, Value,
    Approval, Grade [, extra: array<struct<name, value>> of other columns].

    Unreadable files explode to nothing (no Filter node, so no predicate is
    pushed below the header resolution and re-evaluated there)."""
    keep = [STATION, "variable", "file_name"] + [f"i_{t}" for t, _ in RESOLVE_SPEC]
    if keep_extra:
        keep.append("hdr")
    # Each line is split inside the generator: a later filter on a parsed
    # field stops at the Generate and cannot inline (repeat) the split.
    def parts(line_no: Column, line: Column) -> Column:
        return F.struct(line_no.alias("line_no"), split_csv_line(line).alias("cells"))

    if "line" in table.columns:  # one line a row: no loop over an array, so the plan stays compiled
        cells_of = F.when(F.col("line_no").isNotNull(), F.array(parts(F.col("line_no"), F.col("line"))))
    else:
        cells_of = F.transform("lines", lambda x: parts(x["line_no"], x["line"]))
    exploded = table.select(*keep, F.explode(F.when(F.col("header_ok"), cells_of)).alias("__l"))
    parsed = exploded.select(*keep, F.col("__l.line_no").alias("line_no"), F.col("__l.cells").alias("__cells"))
    cells = F.col("__cells")

    def pick(target: str) -> Column:
        return _na(unquote(F.trim(F.try_element_at(cells, F.col(f"i_{target}") + 1))))

    cols = [
        F.col(STATION), F.col("variable"), F.col("file_name"), F.col("line_no"),
        parse_time(pick(DATE)).alias(DATE),
        pick(PARAMETER).alias(PARAMETER),
        pick(VALUE).try_cast("double").alias(VALUE),
        pick(APPROVAL).alias(APPROVAL),
        pick(GRADE).alias(GRADE),
    ]
    if keep_extra:
        used = F.array_compact(F.array(*[F.col(f"i_{t}") for t, _ in RESOLVE_SPEC]))
        idx = F.filter(F.sequence(F.lit(0), F.size("hdr") - 1), lambda i: ~F.array_contains(used, i))
        extra = F.transform(idx, lambda i: F.struct(F.element_at("hdr", i + 1).alias("name"),
                                                    _na(unquote(F.trim(F.try_element_at(cells, i + 1)))).alias("value")))
        cols.append(extra.alias("extra"))
    return parsed.select(*cols)
