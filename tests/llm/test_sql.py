"""Corpus queries against their SQL in DuckDB."""

import duckdb
import pytest

from tableforge.llm import registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found, df = con.sql(registry.ORACLES[name]), registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    order = [found.columns.index(c) for c in columns]
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    assert len(ours) == 1000 and ours == sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=str)
