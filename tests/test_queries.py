"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest


from tideline.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata"
SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(columns, found):
    order = sorted(columns)
    at = [list(columns).index(c) for c in order]
    return order, sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in at) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.sql(ORACLE_SQL[name])
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
