"""Every registered query vs its DuckDB statement on the smallest driver tables."""

from __future__ import annotations

import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from tools.check_oracle import TABLES, digest

QUERIES = entry.queries()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["domain", "window_start", "window_end", "pages_created", "unique_authors",
                          "avg_title_length", "trend"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    rel = duck.sql(ORACLE[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    assert spark_types == duck_types
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    expect = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expect)
    assert digest(df.columns, rows)[0] == digest(cols, expect)[0]
