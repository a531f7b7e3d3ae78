import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from squadbook.functions import (
    clean_numeric,
    clean_timestamp,
    coerce,
    composite_id,
    contains_phrase,
    content_checksum,
    digits_in,
    escape_regex,
    normalize_name,
    segments,
    strip,
    tolerant_integer,
)
from squadbook.runtime import scratch_path


def values(spark, texts, expression):
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select(expression(F.col("x")))
    return [row[0] for row in rows.collect()]


@pytest.mark.parametrize(
    "header, name",
    [
        (" Sofifa ID ", "sofifa_id"),
        ("Wage (EUR)", "wage_eur"),
        ("Win%", "win_pct"),
        ("a/b", "a_b"),
        ("x(y)z", "x_yz"),
        ("%", "pct"),
        ("__A--b__", "a_b"),
    ],
)
def test_normalize_name(header, name):
    assert normalize_name(header) == name


def test_clean_numeric(spark, ansi):
    texts = ["€1.5M", "72+3", "1,234", "-5", "180cm", "2018-19", "1e3", "7.8E7", "abc", "  ", None, "NaN"]
    assert values(spark, texts, lambda x: clean_numeric(x, "double")) == [
        1.5, 72.0, 1.0, -5.0, 180.0, 2018.0, 1000.0, 78000000.0, None, None, None, None,
    ]
    assert values(spark, ["12.7", "180cm", "1e3", "99999999999", "x"], lambda x: clean_numeric(x, "int")) == [
        12, 180, 1000, None, None,
    ]
    assert values(spark, ["9007199254740993"], lambda x: clean_numeric(x, "bigint")) == [9007199254740993]


def test_tolerant_integer(spark, ansi):
    texts = ["2021", " 2021.0 ", "Jun 30, 2021", "", None, "99999999999"]
    assert values(spark, texts, lambda x: tolerant_integer(x, "int")) == [2021, 2021, None, None, None, None]


def test_clean_timestamp(spark, ansi):
    texts = ["1987-06-24", " ", "n/a", None, "2020-01-02 03:04:05"]
    assert values(spark, texts, clean_timestamp) == [
        datetime(1987, 6, 24), None, None, None, datetime(2020, 1, 2, 3, 4, 5),
    ]


def test_coerce_keeps_numbers_out_of_text(spark, ansi):
    df = spark.createDataFrame([(78000000.0,), (500.0,)], "x double")
    field = df.schema["x"]
    assert [r[0] for r in df.select(coerce(F.col("x"), field.dataType, "double")).collect()] == [7.8e7, 500.0]
    assert [r[0] for r in df.select(coerce(F.col("x"), field.dataType, "int")).collect()] == [78000000, 500]


def test_digits_in(spark, ansi):
    urls = ["https://x/player/158023/a/220069", "https://x/none", None]
    assert values(spark, urls, digits_in) == [158023, None, None]


def test_composite_id_is_null_without_a_part(spark):
    df = spark.createDataFrame([("male", 2020, 158023), ("female", 2016, None)], "g string, y int, k long")
    ids = df.select(composite_id(F.col("g"), F.col("y"), F.col("k"))).collect()
    assert [r[0] for r in ids] == ["M_2020_158023", None]


def test_strip_removes_any_white_space(spark):
    texts = ["  a b\t\n", " x\x1f", "", None]
    assert values(spark, texts, strip) == ["a b", "x", "", None]


def test_segments(spark):
    assert values(spark, ["neymar jr.", "..é_1!", ""], segments) == [
        ["neymar", " ", "jr", "."], ["..", "é_1", "!"], [],
    ]


def test_escape_regex(spark):
    texts = ["a.b", "c++ (d)", "e_f é"]
    escaped = values(spark, texts, escape_regex)
    assert all(re.fullmatch(e, t) for e, t in zip(escaped, texts))


def test_contains_phrase(spark):
    def found(text, phrase):
        return values(spark, [text], lambda x: contains_phrase(x, F.lit(phrase)))[0]

    assert found("The L. Messi show", "l. messi")
    assert not found("xl. messi", "l. messi")
    assert not found("neymar jr. is", "Neymar Jr.")
    assert found("neymar jr.x", "Neymar Jr.")
    assert found("Mbappé scores", "mbappé")
    assert not found("mbappés", "mbappé")


def test_checksum_ignores_order_and_partitioning(spark):
    df = spark.range(1000).withColumn("t", F.when(F.col("id") % 3 == 0, F.col("id").cast("string")))

    def checksum(frame):
        return frame.agg(content_checksum(frame.columns)).first()[0]

    shuffled = df.repartition(7, F.hash("id")).orderBy(F.desc("id"))
    assert checksum(df) == checksum(shuffled)
    assert checksum(df) != checksum(df.where("id < 999"))
    assert checksum(df.where("id < 0")) == "0"


def test_scratch_path_uses_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(base) and first != second
