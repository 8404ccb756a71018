"""Every named query against its DuckDB statement at sf0.01 (the driver's correctness gate)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.oracle import ORACLE
from conftest import SF01

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_registered_set():
    """What the driver sees: every core query with its statement; only opN_ queries and the pipeline may go without."""
    queries, statements = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(ORACLE) <= set(statements) <= set(queries)
    assert all(n == "pipeline" or n.startswith("op") for n in set(queries) - set(statements))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "post_json", "topic", "topic_partition", "partition_offset"]
