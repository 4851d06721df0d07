"""Each registered query against its oracle in DuckDB, on the smallest tables."""

import datetime
import math
from collections import Counter

import duckdb
import pytest

from tipoff.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)[:19].replace(" 00:00:00", "")
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*(f"`{c}`" for c in cols)).collect())
    if name in ORACLE:
        r = duck.execute(ORACLE[name])
        at = {d[0]: i for i, d in enumerate(r.description)}
        assert sorted(at) == cols
        assert got == Counter(tuple(plain(row[at[c]]) for c in cols) for row in r.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
