"""The queries that SQL expresses, against DuckDB."""

import duckdb
import pytest

from glossweave.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(show(r[c]) for c in sorted(df.columns)) for r in df.collect())
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    at = [columns.index(c) for c in sorted(columns)]
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted(tuple(show(r[i]) for i in at) for r in found.fetchall())
