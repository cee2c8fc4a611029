"""Every query with SQL against it."""

from __future__ import annotations

import glob
from pathlib import Path

import duckdb
import pytest
from rowtide.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, small, name):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, small)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    want = sorted((tuple(r[columns.index(c)] for c in names) for r in result.fetchall()), key=repr)
    assert got == want and want
