"""Every registered query of the core library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tessera.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES.split():
        path = f"{SF}/{t}.parquet"
        out.sql(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return out


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    if name not in registry.oracle_sql():
        assert got
        return
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())
