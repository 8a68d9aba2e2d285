"""Property tests on generated tables."""

import datetime as dt

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugekeep.operators.daily import daily_mean_first
from gaugekeep.operators.merge import new_rows, prefer_first
from gaugekeep.plans.integrate import integrate_publication
from gaugekeep.plans.realtime import realtime_update

STATIONS = st.sampled_from(["s1", "s2", "s3", None])
DAYS = st.sampled_from([dt.date(2024, 1, d) for d in range(1, 6)] + [None])
VALUES = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3)))
ROW = st.tuples(STATIONS, DAYS, st.sampled_from(["Flow", "Level"]), VALUES)
SCHEMA = "STATION_NUMBER string, Date date, Parameter string, Value double"
FAST = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck),
                phases=[Phase.explicit, Phase.reuse, Phase.generate])


def _df(spark, rows, status=None):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("pub_status", F.lit(status)) if status else df


@FAST
@given(inc=st.lists(ROW, max_size=12), stored=st.lists(ROW, max_size=12))
def test_new_rows_never_hit_stored_keys(spark, inc, stored):
    out = new_rows(_df(spark, inc), _df(spark, stored)).collect()
    keys = {(r[0], r[1]) for r in stored}
    assert all((r.STATION_NUMBER, r.Date) not in keys for r in out)
    assert len(out) == sum((r[0], r[1]) not in keys for r in inc)


@FAST
@given(a=st.lists(ROW, max_size=12), b=st.lists(ROW, max_size=12))
def test_prefer_first_one_row_per_key(spark, a, b):
    out = prefer_first([_df(spark, a), _df(spark, b)], order_cols=["Value"]).collect()
    keys = [(r.STATION_NUMBER, r.Date) for r in out]
    assert len(keys) == len(set(keys)) == len({(r[0], r[1]) for r in a + b})
    a_keys = {(r[0], r[1]) for r in a}
    assert all(k in a_keys or k in {(r[0], r[1]) for r in b} for k in keys)


@FAST
@given(pub=st.lists(ROW, max_size=12), stored=st.lists(ROW, max_size=12))
def test_integrate_keeps_every_key(spark, pub, stored):
    out = integrate_publication(_df(spark, pub, "Published"), _df(spark, stored, "Unpublished")).collect()
    k3 = lambda r: (r[0], r[1], r[2])
    assert {k3(r) for r in out} == {k3(r) for r in pub} | {k3(r) for r in stored}
    assert len(out) == len(pub) + sum(k3(r) not in {k3(p) for p in pub} for r in stored)


@FAST
@given(daily=st.lists(ROW, max_size=15), stored=st.lists(ROW, max_size=10))
def test_realtime_update_twice_adds_nothing(spark, daily, stored):
    st_flow = _df(spark, [r for r in stored if r[2] == "Flow"], "Published")
    st_level = _df(spark, [r for r in stored if r[2] == "Level"], "Published")
    d = _df(spark, daily)
    nf, nl = realtime_update(d, st_flow, st_level)
    st_flow2, st_level2 = st_flow.unionByName(nf), st_level.unionByName(nl)
    nf2, nl2 = realtime_update(d, st_flow2, st_level2)
    assert nf2.count() == 0 and nl2.count() == 0


@FAST
@given(vals=st.lists(st.tuples(st.integers(0, 47), VALUES, st.sampled_from(["A", "B", None])),
                     min_size=1, max_size=20, unique_by=lambda t: t[0]),
       parts=st.integers(1, 4))
def test_first_row_independent_of_order_and_partitions(spark, vals, parts):
    rows = [("s", "f", i, dt.datetime(2024, 1, 1 + i // 24, i % 24), v, g) for i, v, g in vals]
    schema = "STATION_NUMBER string, file string, line_no int, Date timestamp_ntz, Value double, Grade string"
    base = daily_mean_first(spark.createDataFrame(rows, schema), ["STATION_NUMBER"], "Date", ["file", "line_no"])
    shuffled = daily_mean_first(spark.createDataFrame(list(reversed(rows)), schema).repartition(parts),
                                ["STATION_NUMBER"], "Date", ["file", "line_no"])
    norm = lambda df: sorted((r.Date, r.Grade, r.line_no, None if r.Value is None else round(r.Value, 6))
                             for r in df.collect())
    assert norm(base) == norm(shuffled)
