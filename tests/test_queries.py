"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from wharfline.queries.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.skipif(not Path(SF).exists(), reason="shared tables are not there")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    frame = QUERIES[name](spark, SF)
    order = sorted(frame.columns)
    got = sorted(tuple(plain(r[c]) for c in order) for r in frame.collect())
    assert name in ORACLES
    answer = con.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == order
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in answer.fetchall())
    assert got == want and got


def test_flagship(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
