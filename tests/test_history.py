"""Bucketed history: J1 leaves it in place, with the results of the plain anti-join."""

import datetime as dt
import re
import uuid

from gaugekeep.columns import DAY_KEYS
from gaugekeep.operators.merge import anti_join, anti_join_in_place
from gaugekeep.sinks.history import open_history, write_history

SCHEMA = "STATION_NUMBER string, Date date, Value double"


def _day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def _frames(spark):
    stored = [(f"s{i % 7}", _day(i), float(i)) for i in range(60)] + [(None, _day(1), 1.0), ("s1", None, 2.0), (None, None, 3.0)]
    incoming = [(f"s{i % 7}", _day(i), float(-i)) for i in range(40, 90)] + [(None, _day(1), 1.0), (None, _day(2), 1.0),
                                                                            ("s1", None, 1.0), ("s2", None, 1.0), (None, None, 0.0)]
    return spark.createDataFrame(stored, SCHEMA), spark.createDataFrame(incoming + incoming[:3], SCHEMA)


def test_in_place_equals_plain_and_history_is_not_shuffled(spark, scratch):
    stored, incoming = _frames(spark)
    want = sorted(map(repr, anti_join(incoming, stored, DAY_KEYS).collect()))
    name = f"h_{uuid.uuid4().hex}"
    written = write_history(stored, name, scratch + "/h", 5)
    own = spark.newSession()  # the catalog is shared: another name for the same folder
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    again = open_history(own, f"{name}_again", scratch + "/h", 5)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, written.collect())) == sorted(map(repr, stored.collect()))
    incoming = own.createDataFrame(incoming.collect(), SCHEMA)
    stored.write.parquet(scratch + "/plain")
    stored_plain = own.read.parquet(scratch + "/plain")
    for history in (own.table(name), again):
        out = anti_join_in_place(incoming, history, DAY_KEYS)
        assert sorted(map(repr, out.collect())) == want
        # the join of whole keys: one exchange, that of the incoming rows, by 5 buckets
        whole = " AND ".join(f"{k} IS NOT NULL" for k in DAY_KEYS)
        plan = out.filter(whole)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
        assert re.findall(r"hashpartitioning\(STATION_NUMBER#\d+, Date#\d+, 5\)", plan)
        assert "hashpartitioning(__r_" not in plan  # the history's keys
        shuffled = anti_join_in_place(incoming, stored_plain, DAY_KEYS)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(__r_" in shuffled  # as it is without buckets


def test_empty_sides(spark, scratch):
    stored, incoming = _frames(spark)
    history = write_history(stored.limit(0), f"h_{uuid.uuid4().hex}", scratch + "/h", 2)
    assert anti_join_in_place(incoming, history, DAY_KEYS).count() == incoming.count()
    assert anti_join_in_place(incoming.limit(0), history, DAY_KEYS).count() == 0
