import random

import pytest
from pyspark.sql import functions as F

from squadbook.operators import (
    conform,
    count_by,
    dedup_first,
    ensure_entity_key,
    fallback_column,
    merge_aliases,
    mode_per_partition,
    normalize_columns,
    order_columns,
    rank_groups_by_avg,
    roster_cohort,
    split_missing_key,
    tag_source,
    take_first,
    top_groups_by_count,
    union_rosters,
    unique_entity_histogram,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_normalize_columns_names_colliding_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b", "a_b", "c"])
    with pytest.raises(ValueError, match="'A b', 'a_b'"):
        normalize_columns(df)


def test_merge_aliases(spark, ansi):
    df = spark.createDataFrame(
        [(None, "s1", "x", None, 2020), ("t2", "s2", "y", "2019", None)],
        "club_name string, club string, nationality string, "
        "contract_valid_until string, contract_end_year int",
    )
    merged = merge_aliases(df)
    assert merged.columns == ["club_name", "nationality_name", "contract_valid_until"]
    assert rows(merged) == [("s1", "x", "2020"), ("t2", "y", "2019")]


def test_merge_aliases_in_priority_order(spark):
    df = spark.createDataFrame([("end", "contract", None)], "contract_end_year string, contract string, club_contract_valid_until string")
    assert rows(merge_aliases(df)) == [("contract",)]


def test_tag_source_and_cohort(spark):
    df = tag_source(spark.range(2), 2022, "Male")
    assert rows(df) == [(0, 2022, "male"), (1, 2022, "male")]
    assert roster_cohort(df, 2022, "MALE").count() == 2
    assert roster_cohort(df, 2021, "male").count() == 0


def test_ensure_entity_key(spark, ansi):
    df = spark.createDataFrame([("7.0",), ("x",)], ["sofifa_id"])
    assert rows(ensure_entity_key(df)) == [(7,), (None,)]
    df = spark.createDataFrame([("a/9/8",)], ["player_url"])
    assert rows(ensure_entity_key(df)) == [("a/9/8", 9)]
    with pytest.raises(ValueError, match="player_url"):
        ensure_entity_key(spark.range(1))


def test_fallback_column(spark):
    df = spark.createDataFrame([("n",)], ["name"])
    assert fallback_column(df, "short_name", "name").columns == ["name", "short_name"]
    assert fallback_column(df, "short_name", "other") is df
    assert fallback_column(df, "name", "other") is df


def test_conform_is_idempotent(spark, ansi):
    types = {"a": "int", "b": "double", "t": "timestamp", "m": "double"}
    df = spark.createDataFrame([("12.7", "72+3", " ", "z")], "a string, b string, t string, o string")
    once = conform(df, ["m", "s"], types)
    assert dict(once.dtypes) == {"a": "int", "b": "double", "t": "timestamp", "o": "string", "m": "double", "s": "string"}
    assert rows(once) == [(12, 72.0, None, "z", None, None)]
    assert rows(conform(once, ["m", "s"], types)) == rows(once)


def test_order_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["z", "b", "k", "a"])
    assert order_columns(df, ["k", "z"]).columns == ["k", "z", "a", "b"]


def test_union_rosters(spark, ansi):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("72+3", 1.5)], "a string, c double")
    union = union_rosters([left, right])
    assert dict(union.dtypes) == {"a": "string", "b": "string", "c": "double"}
    assert rows(union) == [("1", "x", None), ("72+3", None, 1.5)]
    with pytest.raises(ValueError):
        union_rosters([])


def test_dedup_first_is_independent_of_order_and_partitioning(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.randrange(5)) for _ in range(500)]
    expected = None
    for partitions in (1, 3, 8):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, v string, n int").repartition(partitions)
        got = sorted(rows(dedup_first(df, ["k"], [F.desc("n")])), key=str)
        expected = expected or got
        assert got == expected
    assert [r[2] for r in expected] == [4, 4, 4, 4]
    assert {r[1] for r in expected} == {"a"}


def test_dedup_first_thins_a_hot_key_before_the_shuffle(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) as k", "id")
    unique = dedup_first(df, ["k"], ["id"])
    assert unique.count() == 20001
    text = plan(unique)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dedup_first_on_all_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], ["a", "b"])
    assert sorted(rows(dedup_first(df, ["a", "b"]))) == [(1, 2), (1, 3)]


def test_split_missing_key(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b")], "k int, v string")
    good, bad = split_missing_key(df, "k")
    assert rows(good) == [(1, "a")] and rows(bad) == [(None, "b"), (None, "b")]


CLUBS = [("b",), ("b",), ("a",), ("a",), (None,), (None,), ("c",)]


def test_top_groups_by_count(spark):
    df = spark.createDataFrame(CLUBS, "club string")
    top = top_groups_by_count(df, "club", 3)
    assert top.columns == ["club", "player_count", "rank"]
    assert rows(top) == [(None, 2, 1), ("a", 2, 2), ("b", 2, 3)]
    assert rows(top_groups_by_count(df, "club", 9, min_count=2)) == rows(top)
    assert rows(top_groups_by_count(df, "club", 1, where=F.col("club") > "b")) == [("c", 1, 1)]
    assert "TakeOrderedAndProject" in plan(top)
    with pytest.raises(ValueError):
        top_groups_by_count(df, "club", 0)


def test_weighted_count_equals_plain_count(spark):
    df = spark.createDataFrame(CLUBS, "club string")
    counted = count_by(df, ["club"], "n")
    assert rows(top_groups_by_count(counted, "club", 5, weight="n")) == rows(top_groups_by_count(df, "club", 5))


def test_rank_groups_by_avg(spark):
    df = spark.createDataFrame([("a", 20), ("a", 30), ("b", 25), ("c", None), ("d", 40)], "club string, age int")
    assert rows(rank_groups_by_avg(df, "club", "age", 2)) == [("d", 40.0, 1), ("a", 25.0, 2)]
    assert rows(rank_groups_by_avg(df, "club", "age", 5, "ASC")) == [("a", 25.0, 1), ("b", 25.0, 2), ("d", 40.0, 3)]
    with pytest.raises(ValueError):
        rank_groups_by_avg(df, "club", "age", 0)
    with pytest.raises(ValueError):
        rank_groups_by_avg(df, "club", "age", 1, "up")


def test_mode_per_partition(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (2, None), (2, None), (2, "a"), (3, None), (3, "z")], "year int, nation string"
    )
    assert rows(mode_per_partition(df, "year", "nation")) == [(1, "a", 1, 1), (2, None, 2, 1), (3, "z", 1, 1)]


def test_unique_entity_histogram(spark):
    df = spark.createDataFrame(
        [(1, 2020, "x"), (1, 2022, "y"), (2, 2020, "x"), (None, 2020, "x"), (3, 2021, None)], "id int, year int, nation string"
    )
    latest = unique_entity_histogram(df, "id", "nation", [F.desc("year")])
    assert rows(latest) == [(None, 1), ("x", 1), ("y", 1)]
    assert rows(unique_entity_histogram(df, "id", "nation", ["year"])) == [("x", 2), (None, 1)]


def test_take_first(spark):
    df = spark.range(10).repartition(3)
    assert rows(take_first(df, 3, ["id"])) == [(0,), (1,), (2,)]
    assert rows(take_first(df, 0, ["id"])) == []
    assert len(rows(take_first(df, None, ["id"]))) == 10
