"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from silverloom import round_trips  # noqa: F401  registers its queries
from silverloom.queries import QUERIES, SQL

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    say = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v)
    return sorted(columns), sorted(tuple(say(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(SQL[name])
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    assert canonical(df.columns, df.collect()) == theirs


def test_all_have_sql():
    assert set(SQL) == set(QUERIES)
