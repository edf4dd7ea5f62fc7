"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

from gridweave.plans import registry

DATA = os.environ.get("GRIDWEAVE_DATA", "/root/testdata/sf0.001")


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 3)
    return x


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(str(plain(r[i])) for i in order) for r in found))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    df = registry.queries()[name](spark, DATA)
    cur = db.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cur.fetchall())
