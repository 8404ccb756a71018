"""Every named query also runs on the smallest tables (sf0.001: fewer partitions, short logs) and gives
the oracle's row count."""

import duckdb
import pytest

from conftest import SF001
from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck_small():
    con = duckdb.connect()
    for t in ("events", "documents", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_small_tables(spark, duck_small, name):
    n = QUERIES[name](spark, SF001).count()
    assert n == duck_small.execute(f"select count(*) from ({ORACLE[name]})").fetchone()[0]
