"""The registered opN_ functions against their DuckDB statements."""

import duckdb
import pytest

from ledgerline.llm.oracle import ORACLE
from ledgerline.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "labels", "conversations", "benchmark"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_statement(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES[name](spark, SF001)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(map(repr, result.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want and want
