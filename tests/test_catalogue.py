"""Every query with SQL gives the same rows as DuckDB on the small tables."""

import os

import duckdb
import pytest

from paperloom.plans.catalogue import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = duck.execute(ORACLE[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in got.fetchall()), key=repr)
    have = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=repr)
    assert have == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
