"""The corpus operators that SQL can express, against DuckDB."""

import duckdb
import pytest

from genomill.llm.queries import ORACLE_SQL, QUERIES


def norm(v):
    return format(v, ".9g") if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(tuple(map(norm, r)) for r in want.fetchall())
    assert rows and sorted(tuple(map(norm, r)) for r in got.select(*columns).collect()) == rows
