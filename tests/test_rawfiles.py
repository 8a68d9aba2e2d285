"""S3 on real files written to a scratch folder; C4 and C5 on them."""

import datetime as dt
import os

from gaugekeep.operators.reports import empty_stations
from gaugekeep.plans.masters import masters, scraped_tables
from gaugekeep.plans.station_report import station_report, unreadable_rows
from gaugekeep.sources.rawfiles import (newest_files, raw_file_stats, raw_file_table, raw_readings,
                                        read_raw_files, read_raw_listing)
from gaugekeep.sources.rawlines import read_raw_lines

PRE = "\n".join(f"pre {i}, x" for i in range(9))


def _write(root, station, name, header, lines):
    os.makedirs(os.path.join(root, station), exist_ok=True)
    with open(os.path.join(root, station, name), "w") as f:
        f.write(PRE + "\n" + header + "\n" + "".join(l + "\n" for l in lines))


def _files(root):
    _write(root, "08AA001", "Discharge.csv", "Date (PST),Parameter,Value (m3/s),Approval,Grade",
           ["2024-01-01T00:00:00-08:00,47,1.5,Provisional,\"A, b\"",
            "2024-01-01T23:55:00-08:00,47,NA,Provisional,B",
            "",
            "2024-01-02T00:05:00-08:00,47,3.0,Final,C"])
    _write(root, "08AA001", "Water level (unit values).csv", "Parameter,Date (PST),Approval,Value (m),Extra",
           ["46,2024-01-01 10:00:00,Provisional,2.0,e1", "46,2024-01-01 11:00:00,Provisional,4.0,e2"])
    _write(root, "08AA002", "Empty level.csv", "Date (PST),Parameter,Value (m)", [])
    _write(root, "08AA003", "Air temperature+x.csv", "Parameter,Value", ["1,2.0"])   # no Date column
    _write(root, "08AA004", "Discharge.csv", "Date,Parameter,Value", ["bad date,47,1.0", "2024-01-05,47,2.0"])


def test_read_and_parse_real_files(spark, scratch):
    _files(scratch)
    files = read_raw_files(spark, scratch)
    stats = {(r.STATION_NUMBER, r.file_name): (r.variable, r.n_rows, r.header_ok)
             for r in raw_file_stats(raw_file_table(files)).collect()}
    assert stats == {
        ("08AA001", "Discharge.csv"): ("flow", 3, True),
        ("08AA001", "Water level (unit values).csv"): ("water_level (unit values)", 2, True),
        ("08AA002", "Empty level.csv"): ("empty_level", 0, True),
        ("08AA003", "Air temperature+x.csv"): ("air_temp", 1, False),
        ("08AA004", "Discharge.csv"): ("flow", 2, True),
    }
    rows = raw_readings(raw_file_table(files), keep_extra=True).filter("STATION_NUMBER = '08AA001'").orderBy("file_name", "line_no").collect()
    d = rows[0]
    assert d.Date == dt.datetime(2024, 1, 1, 0, 0) and d.Grade == "A, b" and d.Value == 1.5 and d.line_no == 11
    assert rows[1].Value is None and rows[2].line_no == 14
    lvl = [r for r in rows if r.variable != "flow"]
    assert [r.Value for r in lvl] == [2.0, 4.0] and lvl[0].Grade is None
    assert [(e.name, e.value) for e in lvl[0].extra] == [("Extra", "e1")]


def test_masters_and_report_on_real_files(spark, scratch):
    _files(scratch)
    files = read_raw_files(spark, scratch)
    m = {(r.STATION_NUMBER, r.variable, r.Date): r for r in masters(files).collect()}
    f1 = m[("08AA001", "flow", dt.date(2024, 1, 1))]
    assert f1.Value == 1.5 and f1.Grade == "A, b" and f1.Parameter == "Flow"
    assert m[("08AA001", "water_level (unit values)", dt.date(2024, 1, 1))].Value == 3.0
    assert m[("08AA004", "flow", dt.date(2024, 1, 5))].Value == 2.0
    assert m[("08AA004", "flow", None)].Value == 1.0   # a time that cannot be read: kept, without a day
    assert len([k for k in m if k[0] == "08AA004"]) == 2
    flow, level = scraped_tables(masters(files))
    assert level.filter("Parameter = 'Level'").count() == 1
    stations = spark.createDataFrame(
        [("08AA001", "ACTIVE"), ("08AA002", "ACTIVE"), ("08AA003", "ACTIVE"), ("08AA004", None), ("08AA005", "ACTIVE")],
        "STATION_NUMBER string, STATION_OPERATING_STATUS string")
    rep = station_report(stations, files)
    issues = {(r.station_id, r.issue) for r in rep["problem_stations"].collect()}
    assert issues == {("08AA002", "All data files are empty"),
                      ("08AA003", "A fatal error occured during data download for this station"),
                      ("08AA005", "Unable to find download links/no downloadable data found")}
    summ = {r.station_id: r.tables_extracted for r in rep["extraction_summary"].collect()}
    assert summ == {"08AA001": "Discharge.csv, Water level (unit values).csv"}
    assert rep["unreadable_rows"].count() == 0   # 08AA004 (status NULL) was not asked
    bad = [(r.station_id, r.file_name, r.n_unreadable) for r in unreadable_rows(raw_file_table(files)).collect()]
    assert bad == [("08AA004", "Discharge.csv", 1)]
    log = spark.createDataFrame([("08AA001", "Download timed out"), ("08AA005", "Download timed out")],
                                "station_id string, issue string")
    with_log = {(r.station_id, r.issue) for r in station_report(stations, files, log)["problem_stations"].collect()}
    assert with_log == issues | {("08AA001", "Download timed out"), ("08AA005", "Download timed out")}
    cov = rep["coverage"].collect()[0]
    assert (cov.n_stations, cov.n_done, cov.coverage_pct) == (4, 1, 25.0)
    assert [r.STATION_NUMBER for r in empty_stations(raw_file_stats(raw_file_table(files))).collect()] == ["08AA002"]


def test_newest_file_wins_per_variable(spark, scratch):
    _write(scratch, "08BB001", "Discharge.csv", "Date,Parameter,Value", ["2024-01-01,1,1.0", "2024-01-02,1,1.0"])
    _write(scratch, "08BB001", "Flow.csv", "Date,Parameter,Value", ["2024-01-02,1,5.0"])
    out = masters(read_raw_files(spark, scratch)).collect()
    assert [(r.Date, r.Value) for r in out] == [(dt.date(2024, 1, 2), 5.0)]
    listing = read_raw_listing(spark, scratch)
    out2 = masters(read_raw_files(spark, scratch), listing=listing).collect()
    assert [(r.Date, r.Value) for r in out2] == [(dt.date(2024, 1, 2), 5.0)]


def test_listing_matches_file_paths(spark, scratch):
    _files(scratch)
    a = sorted(r.file_path for r in read_raw_listing(spark, scratch).collect())
    b = sorted(r.file_path for r in read_raw_files(spark, scratch).collect())
    assert a == b and any("+" in p for p in a) and any(" " in p for p in a)
    n = {(r.STATION_NUMBER, r.variable): r.file_name for r in newest_files(read_raw_listing(spark, scratch)).collect()}
    assert n[("08AA001", "flow")] == "Discharge.csv"


def test_chunked_files_equal_whole_files(spark):
    """Tiny chunks (3 lines) and one chunk per file give the same readings,
    line numbers and file statistics."""
    from gaugekeep.sources import stand_ins as si
    from sample_paths import SF_SMALL

    def rows(k):
        t = raw_file_table(si.raw_files(spark, SF_SMALL, emptied_every=5, lines_per_chunk=k))
        rd = sorted(tuple(r) for r in raw_readings(t).collect())
        st = sorted(tuple(r) for r in raw_file_stats(t).collect())
        return rd, st

    small, big = rows(3), rows(1 << 30)
    assert small[1] == big[1]
    assert small[0] == big[0]
    kept = si.readings(spark, SF_SMALL).filter("user_id % 5 != 0").count()
    assert len(small[0]) == kept


def test_lines_equal_whole_files(spark, scratch):
    """Files split over many tasks (tiny split size) give the same readings,
    line numbers and statistics as whole-file reads."""
    _files(scratch)
    _write(scratch, "08CC001", "Discharge.csv", "Date,Parameter,Value,Approval,Grade",
           [f"2024-01-{1 + i // 40:02d} {i % 24:02d}:00:00,47,{i}.5,P,\"g, {i}\"" for i in range(400)])
    whole = read_raw_files(spark, scratch)

    def rows(files):
        t = raw_file_table(files)
        return (sorted(tuple(r) for r in raw_readings(t).collect()),
                sorted(tuple(r) for r in raw_file_stats(t).collect()))

    expected = rows(whole)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = spark.read.text(scratch + "/*/*.csv").select("_metadata.file_path", "_metadata.file_block_start")
        assert lines.distinct().count() > 20   # really split
        got = rows(read_raw_lines(spark, scratch + "/*/*.csv"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got[1] == expected[1]
    assert got[0] == expected[0]


def test_duplicate_value_columns_are_fatal(spark, scratch):
    _write(scratch, "08DD001", "Discharge.csv", "Date,Parameter,Value (m3/s),Value (raw)", ["2024-01-01,1,1.0,2.0"])
    _write(scratch, "08DD002", "Discharge.csv", "Grade,Value,Parameter,Date (UTC)", ["A,3.0,1,2024-01-02"])  # order changed
    files = read_raw_files(spark, scratch)
    stations = spark.createDataFrame([("08DD001", "ACTIVE"), ("08DD002", "ACTIVE")],
                                     "STATION_NUMBER string, STATION_OPERATING_STATUS string")
    rep = station_report(stations, files)
    assert {(r.station_id, r.issue) for r in rep["problem_stations"].collect()} == {
        ("08DD001", "A fatal error occured during data download for this station")}
    m = masters(files).collect()
    assert [(r.STATION_NUMBER, r.Value, r.Grade) for r in m] == [("08DD002", 3.0, "A")]


def test_masters_csv_feed_the_realtime_update(spark, scratch):
    from gaugekeep.plans.masters import masters, run_masters
    from gaugekeep.plans.realtime import realtime_update
    from gaugekeep.sources.csvfiles import read_master_csv
    _files(scratch + "/raw")
    run_masters(read_raw_files(spark, scratch + "/raw"), scratch + "/out", csv=True)
    flow = read_master_csv(spark, scratch + "/out/variable=flow")
    level = read_master_csv(spark, scratch + "/out/variable=water_level (unit values)")
    assert flow.count() == 4 and level.count() == 1   # one of them without a day
    want = masters(read_raw_files(spark, scratch + "/raw")).filter("variable = 'flow'")
    cols = ["Date", "Parameter", "Value", "STATION_NUMBER", "Approval", "Grade"]
    assert sorted(map(tuple, flow.select(*cols).collect()), key=repr) == sorted(map(tuple, want.select(*cols).collect()), key=repr)
    schema = "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string"
    empty = spark.createDataFrame([], schema)
    daily = spark.createDataFrame([], "STATION_NUMBER string, Date date, Parameter string, Value double")
    nf, nl = realtime_update(daily, empty, empty, scraped_flow=flow, scraped_level=level)
    assert nf.count() == 4 and [r.Parameter for r in nl.collect()] == ["Level"]


def test_stand_in_chunks_are_bounded(spark):
    """However many readings a station has, no chunk exceeds the bound."""
    from pyspark.sql import functions as F
    from gaugekeep.sources import stand_ins as si
    from sample_paths import SF_SMALL
    files = si.raw_files(spark, SF_SMALL, lines_per_chunk=5)
    data = files.filter("first_line > 10").select(F.size(F.split("text", "\n")).alias("n"))
    assert data.agg(F.max("n")).first()[0] <= 5
    heads = files.filter("first_line = 1")
    assert heads.count() == files.select("file_path").distinct().count()   # one head chunk per file


def test_earlier_scraped_row_wins_within_a_file(spark, scratch):
    import os
    from gaugekeep.plans.realtime import realtime_update
    from gaugekeep.sources.csvfiles import read_master_csv
    os.makedirs(scratch + "/flow")
    with open(scratch + "/flow/part-0.csv", "w") as f:
        f.write("Date,Parameter,Value,STATION_NUMBER,Approval,Grade\n"
                + "".join(f"2024-01-0{1 + i % 2},Flow,{v},08A,P,NA\n" for i, v in enumerate([5.0, 6.0, 7.0, 8.0])))
    scraped = read_master_csv(spark, scratch + "/flow", order_col="__order")
    schema = "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string"
    empty = spark.createDataFrame([], schema)
    daily = spark.createDataFrame([], "STATION_NUMBER string, Date date, Parameter string, Value double")
    nf, _ = realtime_update(daily, empty, empty, scraped_flow=scraped, scraped_order=["__order"])
    assert sorted((str(r.Date), r.Value) for r in nf.collect()) == [("2024-01-01", 5.0), ("2024-01-02", 6.0)]
    assert "__order" not in nf.columns


def test_jobs_on_lines(spark, scratch):
    """C4 and C5 give the same results from lines of split files as from whole files."""
    _files(scratch)
    stations = spark.createDataFrame([(s, "ACTIVE") for s in ("08AA001", "08AA002", "08AA003", "08AA004")],
                                     "STATION_NUMBER string, STATION_OPERATING_STATUS string")

    def run(files):
        m = sorted((tuple(r) for r in masters(files).collect()), key=repr)
        rep = station_report(stations, files)
        return m, {k: sorted(tuple(r) for r in df.collect()) for k, df in rep.items()}

    expected = run(read_raw_files(spark, scratch))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = run(read_raw_lines(spark, scratch + "/*/*.csv"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == expected


def _small_splits(spark, size):
    return {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}


def _with(spark, conf, job):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return job()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_headers_at_any_place(spark, scratch):
    """Splits of a few bytes: the header lies in a later split, its text also in
    the preamble and among the data; carriage returns, no last line end."""
    head = "Date,Parameter,Value,Other"
    os.makedirs(scratch + "/s1")
    text = [head, "p", head, "", "p", "p", "p", "p", "p", head, "2024-01-01,47,1.0, a ", head, "2024-01-02,47,2.0,\" b \""]
    with open(scratch + "/s1/Discharge.csv", "w", newline="") as f:
        f.write("\r\n".join(text))
    os.makedirs(scratch + "/s2")
    with open(scratch + "/s2/Flow.csv", "w") as f:  # a header on line 9 is none
        f.write("\n".join(text[1:]))
    os.makedirs(scratch + "/s3")
    open(scratch + "/s3/Empty.csv", "w").close()

    def rows(table):
        return (sorted(map(repr, raw_readings(table, keep_extra=True).collect())),
                sorted(map(repr, raw_file_stats(table).filter("file_name <> 'Empty.csv'").collect())))

    want = rows(raw_file_table(read_raw_files(spark, scratch)))
    assert len(want[0]) == 3 and any("value='a'" in r for r in want[0])
    for size in (16, 50, 10_000):
        assert _with(spark, _small_splits(spark, size), lambda: rows(read_raw_lines(spark, scratch + "/*/*.csv"))) == want


def test_other_cuts_between_the_passes_fail(spark, scratch):
    import pytest
    _files(scratch)
    table = _with(spark, _small_splits(spark, 64), lambda: read_raw_lines(spark, scratch + "/*/*.csv"))
    with pytest.raises(Exception, match="cut otherwise"):
        table.collect()


def test_lines_are_not_shuffled(spark, scratch):
    _files(scratch)
    table = read_raw_lines(spark, scratch + "/*/*.csv")
    df = raw_readings(table)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "collect_list" not in plan
    assert "SortAggregate" not in plan


def test_written_station_files(spark, scratch):
    """The stand-in's files on disk hold what its chunks in memory hold."""
    from gaugekeep.sources import stand_ins as si
    from sample_paths import SF_SMALL
    si.write_raw_files(spark, SF_SMALL, scratch + "/raw")
    disk = raw_readings(read_raw_lines(spark, si.raw_paths(scratch + "/raw"), si.raw_name))
    memory = raw_readings(raw_file_table(si.raw_files(spark, SF_SMALL)))
    assert sorted(map(repr, disk.collect())) == sorted(map(repr, memory.collect()))


def test_superseded_files_are_never_opened(spark, scratch):
    from gaugekeep.plans.masters import masters_from_folder, read_newest
    _files(scratch)
    _write(scratch, "08BB001", "Discharge [a].csv", "Date,Parameter,Value", ["2024-01-01,1,1.0"])
    _write(scratch, "08BB001", "Flow {b}?.csv", "Date,Parameter,Value", ["2024-01-02,1,5.0"])
    table = read_newest(spark, scratch)
    opened = {f.rsplit("/", 1)[1] for f in table.inputFiles() if "08BB001" in f}
    assert len(opened) == 1 and "Flow" in opened.pop()
    want = masters(read_raw_files(spark, scratch), keep_extra=True).collect()
    assert sorted(map(repr, masters_from_folder(spark, scratch, keep_extra=True).collect())) == sorted(map(repr, want))
    assert [r.Value for r in want if r.STATION_NUMBER == "08BB001"] == [5.0]


def test_earlier_row_wins_however_the_csv_is_split(spark, scratch):
    from gaugekeep.plans.realtime import realtime_update
    from gaugekeep.sources.csvfiles import read_master_csv
    os.makedirs(scratch + "/flow")
    with open(scratch + "/flow/part-0.csv", "w") as f:
        f.write("Date,Parameter,Value,STATION_NUMBER,Approval,Grade\n"
                + "".join(f"2024-01-{1 + i % 9:02d},Flow,{i}.5,08A,P,NA\n" for i in range(200)))
    schema = "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string"
    empty = spark.createDataFrame([], schema)
    daily = empty.drop("pub_status")

    def first():
        scraped = read_master_csv(spark, scratch + "/flow", order_col="__order")
        assert scraped.select("__order.split").distinct().count() > 5
        nf, _ = realtime_update(daily, empty, empty, scraped_flow=scraped, scraped_order=["__order"])
        return sorted((r.Date.day, r.Value) for r in nf.collect())

    for size in (500, 900):
        assert _with(spark, _small_splits(spark, size), first) == [(d + 1, d + 0.5) for d in range(9)]
