"""Golden values for names (P6, P7), column resolution (P4) and scalar
functions (F5, F6, F8, F10-F14)."""

import datetime as dt

import pytest

from gaugekeep.functions.columns import ColumnResolutionError, flatten_point, resolve_columns
from gaugekeep.functions.names import parameter_label, variable_name
from gaugekeep.functions.scalars import (bytes_to_mb, days_between, is_leap_year, path_basename, r_round,
                                         release_stamp, window_start, yyyymmdd)

VARIABLES = [
    ("Precipitation.csv", "precip"),
    ("Precip Total.csv", "precip"),
    ("Air temperature.csv", "air_temp"),
    ("AIR TEMP.csv", "air_temp"),
    ("Water temperature.csv", "water_temp"),
    ("Temperature.csv", "water_temp"),
    ("Discharge.csv", "flow"),
    ("Flow (daily).csv", "flow"),
    ("Water Level (Primary Sensor).csv", "level_prim"),
    ("Water Level (Secondary Sensor).csv", "level_sec"),
    ("Water level (unit values).csv", "water_level (unit values)"),
    ("Level.csv", "level"),
    ("Snow  depth.csv", "snow_ depth"),        # only the first whitespace becomes "_"
    ("Wind xcsv gust.csv", "wind_ gust"),      # ".csv" is a regex: "xcsv" goes too
    ("Precipitation air temp.csv", "precip"),  # first rule wins
]


def test_variable_names(spark):
    df = spark.createDataFrame([(h,) for h, _ in VARIABLES], "h string")
    got = {r.h: r.v for r in df.select("h", variable_name("h").alias("v")).collect()}
    assert got == dict(VARIABLES)


def test_parameter_labels(spark):
    names = ["precip", "air_temp", "water_temp", "flow", "level_prim", "level_sec", "water_level (unit values)"]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = {r.v: r.p for r in df.select("v", parameter_label("v").alias("p")).collect()}
    assert got == {"precip": "Precipitation", "air_temp": "Air Temperature", "water_temp": "Water Temperature",
                   "flow": "Flow", "level_prim": "Level (Primary Sensor)",
                   "level_sec": "Level (Secondary Sensor)", "water_level (unit values)": "water_level (unit values)"}


def test_resolve_columns_order_and_case(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "x", "P", "g")],
                               "extra int, `DATE (PST)` string, `value (m3/s)` double, note string, "
                               "Parameter string, GRADE string")
    out = resolve_columns(df)
    assert out.columns == ["Date", "Parameter", "Value", "Grade", "extra", "note"]


def test_resolve_columns_errors(spark):
    two_dates = spark.createDataFrame([(1, 2, "p", 1.0)], "`Date a` int, `Date b` int, Parameter string, Value double")
    with pytest.raises(ColumnResolutionError):
        resolve_columns(two_dates)
    no_param = spark.createDataFrame([(1, 1.0)], "Date int, Value double")
    with pytest.raises(ColumnResolutionError):
        resolve_columns(no_param)


def test_flatten_point(spark):
    df = spark.createDataFrame([("s", (-120.5, 49.25))], "STATION_NUMBER string, geometry struct<x double, y double>")
    r = flatten_point(df).collect()[0]
    assert (r.longitude, r.latitude) == (-120.5, 49.25) and "geometry" not in flatten_point(df).columns


def test_release_stamp(spark):
    rows = [("a Hydat_sqlite3_20200101.zip b Hydat_sqlite3_20240315.zip", "20240315"),
            ("no stamp here", None),
            ("line1\nHydat_sqlite3_20231015.zip\nline3", "20231015"),
            ("Hydat_sqlite3_2024.zip", None)]
    df = spark.createDataFrame(rows, "t string, want string")
    for r in df.select(release_stamp("t").alias("got"), "want").collect():
        assert r.got == r.want


def test_dates_and_rounding(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 1),
                                 2.5, 3.5, 0.125, 1_499_999.0, "a/b/c.csv", 2024)],
                               "d date, t1 timestamp_ntz, t0 timestamp_ntz, h1 double, h2 double, h3 double, "
                               "n double, p string, y int")
    r = df.select(window_start("d", 18).alias("w18"), window_start("d", 12).alias("w12"),
                  days_between("t1", "t0").alias("lag"), r_round("h1").alias("r1"), r_round("h2").alias("r2"),
                  r_round("h3", 2).alias("r3"), bytes_to_mb("n").alias("mb"), path_basename("p").alias("b"),
                  yyyymmdd("t1").alias("s")).collect()[0]
    assert r.w18 == dt.date(2024, 1, 31) - dt.timedelta(days=547)
    assert r.w12 == dt.date(2024, 1, 31) - dt.timedelta(days=365)
    assert r.lag == 29.5
    assert (r.r1, r.r2, r.r3) == (2.0, 4.0, 0.12)   # half to even
    assert r.mb == 1.0 and r.b == "c.csv" and r.s == "20240130"


def test_leap_years(spark):
    years = [1900, 1996, 2000, 2023, 2024, 2100, 2400]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = {r.y: r.l for r in df.select("y", is_leap_year("y").alias("l")).collect()}
    assert got == {1900: False, 1996: True, 2000: True, 2023: False, 2024: True, 2100: False, 2400: True}
