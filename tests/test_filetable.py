"""C5/A4 with the stored file table; C4 leaves out stations with an unreadable file."""

import os

import pytest

from gaugekeep.plans.masters import masters, masters_from_folder
from gaugekeep.plans.station_report import report_of_stats
from gaugekeep.sinks.snapshots import TableStore
from gaugekeep.sources import filetable
from gaugekeep.sources.filetable import FILES, refresh_file_table
from gaugekeep.sources.rawfiles import raw_file_stats, raw_file_table, read_raw_files

HEADER = "Date,Parameter,Value,Approval,Grade"


def _write(root, station, name, header=HEADER, rows=2):
    os.makedirs(f"{root}/{station}", exist_ok=True)
    with open(f"{root}/{station}/{name}.csv", "w") as f:
        f.write("\n".join(["#"] * 9 + [header] + [f"2024-01-0{i + 1} 00:00:00,Flow,{i},x,y" for i in range(rows)]) + "\n")


def _folder(root):
    _write(root, "08A", "Discharge")
    _write(root, "08A", "Level (new) 100%+1")
    _write(root, "08B", "Discharge")
    _write(root, "08B", "Precip", header="a,b")
    _write(root, "08C", "Discharge", rows=0)
    _write(root, "08E", "Flow")
    open(f"{root}/08E/Precip.csv", "w").close()  # no byte: as if absent


def _rows(df):
    return sorted((r.STATION_NUMBER, r.file_name, r.variable, r.n_rows, r.header_ok) for r in df.collect())


def test_only_changed_files_are_parsed(spark, scratch, monkeypatch):
    root, store = scratch + "/raw", TableStore(spark, scratch + "/store")
    _folder(root)
    seen = []
    read = filetable.read_raw_lines
    monkeypatch.setattr(filetable, "read_raw_lines", lambda s, paths, name: seen.append(len(paths)) or read(s, paths, name))

    def fresh():
        return _rows(raw_file_stats(raw_file_table(read_raw_files(spark, root))))

    assert refresh_file_table(store, root) == 6 and seen == [6]
    assert _rows(store.read(FILES)) == fresh() and len(fresh()) == 6
    number = store.snapshot().number
    assert refresh_file_table(store, root) == 0 and seen == [6] and store.snapshot().number == number

    _write(root, "08C", "Discharge", rows=3)      # grown
    _write(root, "08D", "Discharge")              # new
    os.remove(f"{root}/08A/Discharge.csv")        # gone
    assert refresh_file_table(store, root) == 2 and seen == [6, 2]
    assert _rows(store.read(FILES)) == fresh()
    os.remove(f"{root}/08D/Discharge.csv")
    assert refresh_file_table(store, root) == 0 and store.read(FILES).filter("STATION_NUMBER = '08D'").isEmpty()


def test_report_and_masters_agree(spark, scratch):
    root, store = scratch + "/raw", TableStore(spark, scratch + "/store")
    _folder(root)
    refresh_file_table(store, root)
    asked = spark.createDataFrame([(s,) for s in ("08A", "08B", "08C", "08E", "08X")], "STATION_NUMBER string")
    issues = {r.station_id: r.issue for r in report_of_stats(asked, store.read(FILES))["problem_stations"].collect()}
    assert set(issues) == {"08B", "08C", "08X"}
    m = masters_from_folder(spark, root)
    assert {r.STATION_NUMBER for r in m.collect()} == {"08A", "08E"}
    assert {r.STATION_NUMBER for r in masters(read_raw_files(spark, root)).collect()} == {"08A", "08E"}


@pytest.mark.parametrize("rows", [0, 2])
def test_all_stations_unreadable(spark, scratch, rows):
    _write(scratch, "08A", "Discharge", header="a,b", rows=rows)
    open(f"{scratch}/08A/Precip.csv", "w").close()
    assert masters_from_folder(spark, scratch).count() == 0
