"""Every registered query of the library against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import plain_queries  # noqa: E402

from quarry.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return tuple(map(norm, value)) if isinstance(value, list | tuple) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in SQL:  # every query without SQL has a plain version
        assert got == sorted((tuple(norm(r[c]) for c in columns) for r in plain_queries.PLAIN[name](sf)), key=repr)
        return
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted((tuple(norm(r[i]) for i in places) for r in result.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["query_id", "row_id", "score", "rank"]
