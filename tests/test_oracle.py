"""Every registered query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

from sample_paths import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(E._own_queries()) - set(ORACLE)
    assert rows_only == set()
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["STATION_NUMBER", "Date", "Parameter", "Value", "pub_status"]
    assert df.count() > 0


def test_sample_is_seeded_and_capped(spark):
    a = [r.STATION_NUMBER for r in QUERIES["sample_stations"](spark, SF_SMALL).collect()]
    b = [r.STATION_NUMBER for r in QUERIES["sample_stations"](spark, SF_SMALL).collect()]
    assert a == b == sorted(a)
    assert len(a) == len(set(a)) == QUERIES["active_stations"](spark, SF_SMALL).count()  # 97 < 100: capped
