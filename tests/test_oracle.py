"""Every registered query against its SQL in DuckDB, over the whole tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import ORACLES
from squadbook.plans.table_queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")

TYPES = {
    "boolean": "BOOLEAN",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def canonical(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(
        tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows
    )


# Columns by which a query's rows come sorted.
SORTED = {
    "top_groups_by_count": ["rank"],
    "large_groups_by_count": ["rank"],
    "top_segments_by_count": ["rank"],
    "rank_groups_by_avg_desc": ["rank"],
    "rank_groups_by_avg_asc": ["rank"],
    "expiring_contracts": ["rank"],
    "average_age_ranking": ["rank"],
    "mode_per_partition": ["year"],
    "popular_nationality": ["year"],
    "take_first": ["conv_id", "turn"],
    "union_conform": ["year", "gender", "player_id", "club_name", "short_name"],
    "build_roster_from_files": ["year", "gender", "player_id"],
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    wanted = duck.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert {c: TYPES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in wanted.description}
    rows = df.collect()
    assert canonical(rows, df.columns) == canonical(wanted.fetchall(), columns)
    if name in SORTED:
        keys = [tuple((r[c] is not None, r[c]) for c in SORTED[name]) for r in rows]
        assert keys == sorted(keys)
