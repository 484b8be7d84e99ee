import os

import duckdb
import pytest

import __spark_entry__ as entry
from cairn.plans.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    assert rows
    if name in ORACLE:
        con = duckdb.connect()
        for f in os.listdir(DATA):
            con.sql(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
        want = con.sql(ORACLE[name])
        cols = sorted(df.columns)
        assert sorted(want.columns) == cols
        flat = lambda v: round(v, 6) if isinstance(v, float) else v
        ours = sorted(str(tuple(flat(r[c]) for c in cols)) for r in rows)
        theirs = sorted(str(tuple(flat(r[want.columns.index(c)]) for c in cols)) for r in want.fetchall())
        assert ours == theirs


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
