"""Every registered query against its SQL over the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from candlewick.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "benchmark", "conversations", "embeddings")


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([row[k] for k in order]) for row in rows)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.columns, got.collect()) == canonical(want.columns, want.fetchall())
