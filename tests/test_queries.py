"""Every query against its SQL, on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from weirflow import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    if isinstance(x, (int, float, decimal.Decimal)) and not isinstance(x, bool):
        return float(x)
    return str(x)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert got
    cursor = duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall()), key=repr)
    assert got == expected


def test_entry(spark):
    df = queries.flagship(spark, SF)
    assert df.count() == 50 and "record" in df.columns


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and set(queries.QUERIES) <= set(e.queries())


@pytest.mark.parametrize("name,function", [("committed_min_lsn", "committed"), ("finalize_lsn", "final_position")])
def test_positions_come_from_the_engine(spark, monkeypatch, name, function):
    from weirflow import queries as core

    called, real = [], getattr(core.changelog, function)
    monkeypatch.setattr(core.changelog, function, lambda *a: called.append(1) or real(*a))
    assert core.QUERIES[name](spark, "/root/testdata/sf0.001").count() == len(called) > 0
