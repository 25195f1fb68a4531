"""Registered queries against their SQL, and against brute force where SQL can't express them."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakecube.llm.queries import ORACLES, QUERIES
from tools.oracle_check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    status, detail = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert status in ("EXACT", "CLOSE"), detail


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names)
