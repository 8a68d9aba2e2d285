"""A1, A2, A3, J1, J2, W1, U1 and the C2 / C3 rules on hand-made tables."""

import datetime as dt


from gaugekeep.operators.daily import daily_mean_first, min_date, realtime_daily_mean
from gaugekeep.operators.merge import new_rows, prefer_first, stack
from gaugekeep.plans.integrate import integrate_publication
from gaugekeep.plans.realtime import realtime_update

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
T = dt.datetime
NAN = float("nan")
STORED = "STATION_NUMBER string, Date date, Parameter string, Value double, pub_status string"


def test_daily_mean_nan_and_null_policies(spark):
    rows = [("s1", T(2024, 1, 1, 1), "Flow", 1.0), ("s1", T(2024, 1, 1, 2), "Flow", NAN),
            ("s1", T(2024, 1, 1, 3), "Flow", 3.0), ("s1", T(2024, 1, 2, 1), "Flow", None),
            ("s1", T(2024, 1, 2, 2), "Flow", NAN), ("s2", T(2024, 1, 1, 23, 59), "Level", 5.0)]
    df = spark.createDataFrame(rows, "STATION_NUMBER string, Date timestamp_ntz, Parameter string, Value double")
    skip = {(r.STATION_NUMBER, r.Date): r.Value for r in realtime_daily_mean(df).collect()}
    assert skip == {("s1", D1): 2.0, ("s1", D2): None, ("s2", D1): 5.0}
    poison = {(r.STATION_NUMBER, r.Date): r.Value for r in realtime_daily_mean(df, null_policy="poison").collect()}
    assert poison == {("s1", D1): None, ("s1", D2): None, ("s2", D1): 5.0}


def test_daily_mean_first_keeps_whole_first_row(spark):
    rows = [("s", "f.csv", 3, T(2024, 1, 1, 3), 3.0, "A", "g3"),
            ("s", "f.csv", 1, T(2024, 1, 1, 1), None, None, None),   # first row: nulls are kept
            ("s", "f.csv", 2, T(2024, 1, 1, 2), 1.0, "B", "g2")]
    df = spark.createDataFrame(rows, "STATION_NUMBER string, file string, line_no int, Date timestamp_ntz, "
                                     "Value double, Approval string, Grade string")
    for parts in (1, 3):
        out = daily_mean_first(df.repartition(parts), ["STATION_NUMBER"], "Date", ["file", "line_no"]).collect()
        assert len(out) == 1
        r = out[0]
        assert (r.Value, r.Approval, r.Grade, r.line_no) == (2.0, None, None, 1)


def test_empty_input_passes_through(spark):
    df = spark.createDataFrame([], "STATION_NUMBER string, Date timestamp_ntz, Parameter string, Value double")
    assert realtime_daily_mean(df).count() == 0
    assert min_date(df).collect()[0].min_date is None


def test_null_safe_anti_join(spark):
    left = spark.createDataFrame([("a", D1), (None, D1), ("b", None), ("c", D2)], "STATION_NUMBER string, Date date")
    right = spark.createDataFrame([("a", D1), (None, D1), ("b", None)], "STATION_NUMBER string, Date date")
    assert [tuple(r) for r in new_rows(left, right).collect()] == [("c", D2)]
    plan = new_rows(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prefer_first_source_then_order(spark):
    a = spark.createDataFrame([("s", D1, 10.0, 2), ("s", D1, 11.0, 1)], "STATION_NUMBER string, Date date, Value double, n int")
    b = spark.createDataFrame([("s", D1, 1.0, 0), ("s", D2, 2.0, 0)], "STATION_NUMBER string, Date date, Value double, n int")
    got = {r.Date: r.Value for r in prefer_first([a, b], order_cols=["n"]).collect()}
    assert got == {D1: 11.0, D2: 2.0}


def test_stack_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, extra string")
    b = spark.createDataFrame([(2,)], "k int")
    assert sorted((r.k, r.extra) for r in stack(a, b, b).collect()) == [(1, "x"), (2, None), (2, None)]


def test_integrate_publication_properties(spark):
    stored = spark.createDataFrame([("s1", D1, "Flow", 1.0, "Unpublished"), ("s1", D2, "Flow", 2.0, "Unpublished"),
                                    ("s2", D1, "Flow", 7.0, "Published")], STORED)
    pub = spark.createDataFrame([("s1", D1, "Flow", 1.5, "Published")], STORED)
    out = {(r.STATION_NUMBER, r.Date): (r.Value, r.pub_status) for r in integrate_publication(pub, stored).collect()}
    # published keys win; uncovered stored rows stay, including a retracted published one
    assert out == {("s1", D1): (1.5, "Published"), ("s1", D2): (2.0, "Unpublished"), ("s2", D1): (7.0, "Published")}
    dropped = integrate_publication(pub, stored, drop_retracted=True)
    assert dropped.count() == 2


def test_realtime_update_rules(spark):
    stored_flow = spark.createDataFrame([("s1", D1, "Flow", 1.0, "Published")], STORED)
    stored_level = spark.createDataFrame([], STORED)
    daily = spark.createDataFrame([("s1", D1, "Flow", 9.0), ("s1", D2, "Flow", None), ("s1", D2, "Level", 4.0)],
                                  "STATION_NUMBER string, Date date, Parameter string, Value double")
    scraped = spark.createDataFrame([("s1", D2, "water_level", 40.0)], "STATION_NUMBER string, Date date, Parameter string, Value double")
    nf, nl = realtime_update(daily, stored_flow, stored_level, scraped_level=scraped)
    assert [(r.Date, r.Value) for r in nf.collect()] == [(D2, None)]   # a stored day is never changed (D15 kept)
    assert [(r.Date, r.Parameter, r.Value) for r in nl.collect()] == [(D2, "Level", 40.0)]  # scraped wins
    nf2, _ = realtime_update(daily, stored_flow, stored_level, skip_null_days=True)
    assert nf2.count() == 0
    empty = daily.limit(0)
    a, b = realtime_update(empty, stored_flow, stored_level)
    assert a.count() == 0 and b.count() == 0


def test_update_from_readings_and_read_table(spark, scratch):
    from gaugekeep.plans.realtime import realtime_update_from_readings
    from gaugekeep.sources.archive import read_table
    readings = spark.createDataFrame(
        [("s1", T(2024, 1, 1, 1), "Flow", 1.0), ("s1", T(2024, 1, 1, 2), "Flow", 3.0),
         ("s1", T(2024, 1, 2, 1), "Level", 5.0), ("s1", T(2024, 1, 2, 1), "Air Temperature", 9.0)],
        "STATION_NUMBER string, Date timestamp_ntz, Parameter string, Value double")
    stored = spark.createDataFrame([], STORED)
    stored.write.parquet(scratch + "/empty_flow")
    nf, nl = realtime_update_from_readings(readings, read_table(spark, scratch + "/empty_flow"), stored)
    assert [(r.Date, r.Value) for r in nf.collect()] == [(D1, 2.0)]
    assert [(r.Date, r.Parameter, r.Value) for r in nl.collect()] == [(D2, "Level", 5.0)]
