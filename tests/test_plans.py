"""Physical-plan checks: no nested-loop joins, pushed filters, top-1 before
the shuffle, two-phase aggregates, no Python in the plans."""

import re

import pytest

import __spark_entry__ as E

from sample_paths import SF_SMALL

QUERIES = E._own_queries()


def _plan(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas", "FlatMapGroupsInArrow", "MapInArrow"):
        assert bad not in plan, f"{name}: {bad}"


def test_anti_joins_are_equi_joins(spark):
    plan = _plan(QUERIES["new_flow_rows"](spark, SF_SMALL))
    assert "LeftAnti" in plan and ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan)


def test_stored_since_filter_reaches_scan(spark):
    df = QUERIES["stored_since"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)


def test_window_group_limit_before_shuffle(spark):
    df = QUERIES["scraped_first_flow"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_daily_mean_is_two_phase(spark):
    plan = QUERIES["realtime_daily_mean"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert "partial_avg" in plan


def test_raw_parse_needs_no_join(spark, scratch):
    """Chunks carry their header: parsing is narrow (no join, no exchange)
    once the chunks exist."""
    from gaugekeep.sources import stand_ins as si
    from gaugekeep.sources.rawfiles import raw_file_table, raw_readings
    si.raw_files(spark, SF_SMALL, lines_per_chunk=7).write.parquet(scratch + "/raw")
    df = raw_readings(raw_file_table(spark.read.parquet(scratch + "/raw")))
    plan = _plan(df)
    assert "Join" not in plan and "Exchange" not in plan
