"""Registered queries of the subpackage that SQL can express, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from pacegrid.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    found = duck.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(r) for r in found.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == expected
