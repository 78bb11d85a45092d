"""Every query of the change-log engine against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from changeloom.plans import queries as plans

SF = "/root/testdata/sf0.001"


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else None if v is None else str(v)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_query(spark, sql, name):
    got = plans.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = sql.execute(plans.ORACLE[name])
    place = [[d[0] for d in want.description].index(c) for c in columns]
    rows = sorted([plain(r[c]) or "" for c in columns] for r in got.collect())
    assert rows == sorted([plain(r[k]) or "" for k in place] for r in want.fetchall())


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["user_id", "event_type", "value", "ver", "lsn"]
    assert set(plans.QUERIES) <= set(__spark_entry__.queries())
