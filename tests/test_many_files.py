"""Many small station files: how they are written, listed and dealt to tasks."""

import os

import pyarrow as pa

from gaugekeep.columns import STATION
from gaugekeep.plans.masters import masters_from_folder
from gaugekeep.session import SMALL_FILES_CONF
from gaugekeep.sources import filetable, smallfiles
from gaugekeep.sources import stand_ins as si
from gaugekeep.sources.filetable import list_raw_files, literal_paths
from gaugekeep.sources.rawfiles import HEADER_INFO
from gaugekeep.sources.rawlines import _lines, read_raw_lines
from gaugekeep.sources.smallfiles import Listed, read_listed_lines
from sample_paths import SF_SMALL

COLUMNS = ["file_path", STATION, "file_name", "variable", *HEADER_INFO[:2], "n_rows", *HEADER_INFO[2:], "line_no", "line"]


def _text_files(root, n):
    for i in range(n):
        os.makedirs(f"{root}/s{i}/h")
        with open(f"{root}/s{i}/h/a.txt", "w") as f:
            f.write(f"{i}\n")


def _content(root):
    found = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if n.endswith(".txt"):
                with open(os.path.join(folder, n), encoding="utf-8") as f:
                    found[os.path.relpath(folder, root)] = f.read()
    return found


def test_files_as_sparks_writer_gives_them(spark, scratch, monkeypatch):
    si.write_raw_files(spark, SF_SMALL, f"{scratch}/own", emptied_every=5, older=True, headless_every=4)
    assert not [n for _, _, names in os.walk(f"{scratch}/own") for n in names if not n.endswith(".txt")]
    with monkeypatch.context() as m:
        m.setattr(si, "_local_folder", lambda root: None)
        si.write_raw_files(spark, SF_SMALL, f"{scratch}/spark", emptied_every=5, older=True, headless_every=4)
    want = _content(f"{scratch}/spark")
    assert len(want) > 100 and _content(f"{scratch}/own") == want


def test_folder_names_as_sparks_writer_gives_them(spark, scratch):
    values = ["a b", "x/y", "p%q", "c:d=e", "[f]{g}", "h'i\"j", "k*l?", "m\\n", "é", "", None]
    rows = spark.createDataFrame([(v, v, "t") for v in values], f"{si.STATION} string, heading string, value string")
    rows.write.partitionBy(si.STATION, "heading").text(f"{scratch}/spark")
    sorted_rows = rows.coalesce(1).sortWithinPartitions(si.STATION, "heading")
    folder = f"{scratch}/own"
    sorted_rows.mapInArrow(lambda b: si._written(b, folder), "n int").collect()
    names = lambda root: {os.path.relpath(d, root) for d, _, n in os.walk(root) if any(x.endswith(".txt") for x in n)}
    assert names(folder) == names(f"{scratch}/spark")


def test_listing_by_folder_follows_the_pattern(spark, scratch):
    root = f"{scratch}/a (1)+b"
    _text_files(root, 5)
    os.makedirs(f"{root}/s1/other/deep")
    for other in ("s1/b.txt", "s1/h/c.csv", "s1/other/d.txt", "s1/other/deep/e.txt", "f.txt"):
        with open(f"{root}/{other}", "w") as f:
            f.write("x\n")

    def names(pattern):
        return sorted(os.path.relpath(r.path.removeprefix("file:"), root) for r in list_raw_files(spark, root, pattern).collect())

    assert names("*/*/*.txt") == ["s0/h/a.txt", "s1/h/a.txt", "s1/other/d.txt", "s2/h/a.txt", "s3/h/a.txt", "s4/h/a.txt"]
    assert names("*/h/*.txt") == [f"s{i}/h/a.txt" for i in range(5)]
    assert names("s[12]/h/*") == ["s1/h/a.txt", "s1/h/c.csv", "s2/h/a.txt"]
    assert names("*.txt") == ["f.txt"]


def test_a_task_takes_many_files_and_other_queries_none_of_it(spark, scratch):
    _text_files(scratch, 300)
    spark = spark.newSession()  # without settings that other tests leave
    files = list_raw_files(spark, scratch, "*/*/*.txt")
    lines = _lines(spark, literal_paths(files))
    # at 4 MB for opening a file a task took no more than 32
    assert lines.rdd.getNumPartitions() <= max(4, spark.sparkContext.defaultParallelism)
    assert sorted(int(r.line) for r in lines.collect()) == list(range(300))
    assert all(spark.conf.get(k, None) is None for k in SMALL_FILES_CONF)


def _odd_files(root):
    head = "Date,Parameter,Value,Other"
    texts = {
        "s1/Discharge.csv": "\r\n".join([head, "p", head, "", *"ppppp", head, "2024-01-01,47,1.0, a ", head, "2024-01-02,47,2.0,\" b \"\r"]),
        "s1/Older [a]%20+é.csv": "\n".join([*"ppppppppp", head, "2024-01-03,47,3.0,c", "", ""]),
        "s2/Flow.csv": "\n".join([*"pppppppp", head, "2024-01-01,47,1.0,a"]),  # a header on line 9 is none
        "s2/Discharge.csv": "\n".join([*"ppppppppp", head, "2024-01-01,47,1.0,a\n"]),
        "s3/Discharge.csv": "﻿" + "\n" * 9 + head + "\n" + "".join(f"2024-01-0{1 + i % 9},47,{i}.5,{'é' * (i % 7)}\n" for i in range(500)),
        "s3/Empty.csv": "", "s4/Blank.csv": "\n", "s5/_hidden.csv": head, "s5/.hidden.csv": head,
    }
    for path, text in texts.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    with open(f"{root}/s4/Precip.csv", "wb") as f:  # not UTF-8
        f.write(b"p\n" * 9 + b"Date,Parameter,Value,Grade\n2024-01-01,47,1.0,\xff\xfe\n")


def test_tasks_list_and_read_as_sparks_readers(spark, scratch, monkeypatch):
    """Chunks of a few bytes, a file too large for one task; listing, lines and the stations left out."""
    root = f"{scratch}/a (1)+b"
    _odd_files(root)
    with monkeypatch.context() as m:
        m.setattr(filetable, "on_disk", lambda spark, root: None)
        m.setattr(smallfiles, "on_disk", lambda spark, root: None)
        want_listing = sorted(list_raw_files(spark, root).collect())
        want = [sorted(map(repr, read_raw_lines(spark, literal_paths(list_raw_files(spark, root)), None, w).collect())) for w in (False, True)]
    assert len(want_listing) == 7 and want[0] != want[1] and len(want[0]) > 500
    assert sorted(list_raw_files(spark, root).collect()) == want_listing
    monkeypatch.setattr(smallfiles, "MANY_FILES", 1)
    for whole, chunk in ((1 << 20, 1 << 20), (1 << 20, 64), (1000, 64)):
        monkeypatch.setattr(smallfiles, "WHOLE_BYTES", whole)
        monkeypatch.setattr(smallfiles, "CHUNK_BYTES", chunk)
        listed = Listed(list_raw_files(spark, root))
        assert len(listed) == 7
        got = [sorted(map(repr, read_listed_lines(spark, listed, None, w).select(*COLUMNS).collect())) for w in (False, True)]
        assert got == want
        assert not [f for f in read_listed_lines(spark, listed).inputFiles() if f.endswith(".csv") and "s3" not in f]


def test_paths_of_many_files_stay_out_of_the_driver(spark, scratch, monkeypatch):
    for i in range(150):
        os.makedirs(f"{scratch}/s{i}")
        with open(f"{scratch}/s{i}/Discharge.csv", "w") as f:
            f.write("p\n" * 9 + f"Date,Parameter,Value\n2024-01-01,47,{i}.0\n")

    def none(*_):
        raise AssertionError("paths collected")

    monkeypatch.setattr(smallfiles, "literal_paths", none)
    assert sorted(r.Value for r in masters_from_folder(spark, scratch).collect()) == [float(i) for i in range(150)]


def test_runs_of_equal_keys():
    keys = [pa.array(["a", "a", None, None, "b", "b"]), pa.array(["x", "y", "y", "y", "y", "y"])]
    assert list(si._runs(keys)) == [(0, 1), (1, 2), (2, 4), (4, 6)]
    assert list(si._runs([pa.array([], pa.string())] * 2)) == []


def test_flat_files_hold_the_same_lines_in_one_folder_a_station(spark, scratch):
    """No folder for each file; two keys in one file and missing ones included."""
    ev = spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate([(7, "view"), (7, "click"), (100070, "view"), (100071, "view"), (None, "error"), (8, None)])],
                               "event_id long, user_id long, event_type string")
    ev = ev.selectExpr("event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "user_id", "event_type", "1.5D AS value", "'{\"a\":1}' AS props")
    ev.write.parquet(f"{scratch}/sf/events.parquet")
    for flat in (True, False):
        si.write_raw_files(spark, f"{scratch}/sf", f"{scratch}/{flat}", headless_every=4, flat=flat)
    read = {flat: list_raw_files(spark, f"{scratch}/{flat}", p) for flat, p in ((True, si.raw_pattern(scratch)), (False, "*/*/*.txt"))}
    assert si.raw_pattern("hdfs://a/b", "Flow") == "*/heading=Flow/*.txt"
    got = {}
    for flat, files in read.items():
        rows = files.select(si.raw_name(files.path).alias("p"), "path").collect()
        got[flat] = {"/".join(r.p.split("/")[-2:]): open(r.path.removeprefix("file:"), encoding="utf-8").read() for r in rows}
    assert got[True] == got[False] and len(got[True]) == 5
    assert {len(p.split("/")) - len(scratch.split("/")) for (p,) in read[True].select("path").collect()} == {3}
    two = got[True]["0810007/Discharge.csv"].splitlines()  # stations of 100070 and 100071
    assert len(two) == 22 and two[0].startswith("Station,") and two[1].startswith("Station,")
    assert got[True]["0800008/Air temperature.csv"].splitlines()[9].startswith("Date (PST)")


def test_equal_headers_are_resolved_once(spark, scratch, monkeypatch):
    for i in range(150):
        os.makedirs(f"{scratch}/s{i}")
        with open(f"{scratch}/s{i}/Discharge.csv", "w") as f:
            f.write("p\n" * 9 + ("Date,Parameter,Value\n" if i % 50 else "Time\n") + f"2024-01-01,47,{i}.0\n")
    seen = []
    real = smallfiles.resolve_header
    monkeypatch.setattr(smallfiles, "resolve_header", lambda df, *a: (seen.append(df.count()), real(df, *a))[1])
    got = sorted(r.Value for r in masters_from_folder(spark, scratch).collect())
    assert got == [float(i) for i in range(150) if i % 50] and min(seen) == 2
