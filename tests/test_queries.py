"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from rowtide.queries import ORACLES, QUERIES
from rowtide.queries.changes import row_lsn


def normal(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    """The queries of the optional parts are tested beside them."""
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    got = driver.entry(spark).agg({"commit_pos": "count"}).first()[0]
    assert got == 12


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, small, name):
    df = driver.queries()[name](spark, small)
    names = sorted(df.columns)
    got = sorted((tuple(normal(v) for v in r) for r in df.select(*names).collect()), key=repr)
    result = sql.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    place = [columns.index(c) for c in names]
    want = sorted((tuple(normal(r[i]) for i in place) for r in result.fetchall()), key=repr)
    assert got == want
    assert want


def test_entry_positions(spark):
    """The sum of the row positions of the live rows, worked out beforehand."""
    live = driver.entry(spark).withColumn("lsn", row_lsn())
    assert live.agg({"lsn": "sum"}).first()[0] == 51539797008
