"""Queries that SQL can express against DuckDB, over the whole tables."""

from pathlib import Path

import duckdb
import pytest

from squadbook.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    wanted = connection.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(tuple(str(r[c]) for c in columns) for r in got.collect())
    assert rows == sorted(tuple(map(str, r)) for r in wanted.fetchall())


def test_queries_are_named_by_their_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
