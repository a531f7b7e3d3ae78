import json

import pytest
from pyspark.sql import functions as F

from squadbook.operators import take_first
from squadbook.schema import COMMENT_PAGE_SCHEMA, EXPECTED_SEASONS, SEARCH_PAGE_SCHEMA
from squadbook.sources import (
    ManifestError,
    SeasonFile,
    check_manifest,
    expected_frame,
    extract_comments,
    extract_video_ids,
    jdbc_options,
    manifest_frame,
    parse_manifest,
    read_manifest,
    read_roster_csv,
    split_corrupt,
)
from squadbook.sources.rosters import GROUP, SEASON


def full_manifest(base):
    return parse_manifest(
        base, {g: {y: f"{g}_{y}.csv" for y in years} for g, years in EXPECTED_SEASONS.items()}
    )


def test_read_roster_csv_keeps_texts(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("id,v\n1,72+3\n2,\n")
    assert [tuple(r) for r in read_roster_csv(spark, str(file)).collect()] == [("1", "72+3"), ("2", None)]
    assert dict(read_roster_csv(spark, str(file), infer=True).dtypes)["id"] == "int"


def test_check_manifest(spark):
    manifest = [e for e in full_manifest("/d") if (e.group, e.year) != ("female", 2019)]
    doubled = manifest_frame(spark, manifest + manifest)
    gaps = check_manifest(expected_frame(spark), doubled)
    assert [tuple(r) for r in gaps.collect()] == [("female", 2019)]


def test_parse_manifest_rejects_plain_names():
    assert parse_manifest("/d/", {"male": {"2015": "a.csv"}}) == [SeasonFile("male", 2015, "/d/a.csv")]
    with pytest.raises(ManifestError, match="male"):
        parse_manifest("/d", {"male": "a.csv"})


def test_read_manifest_errors(spark, tmp_path):
    manifest = full_manifest(str(tmp_path))
    with pytest.raises(ManifestError, match="2022"):
        read_manifest(spark, manifest[:-1])
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, manifest)


def test_read_manifest_reads_seasons_beyond_the_expected(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("id\n1\n")
    manifest = [SeasonFile("m", 1, str(tmp_path / "a.csv")), SeasonFile("m", 2, str(tmp_path / "b.csv"))]
    [df] = read_manifest(spark, manifest, {"m": [1]})
    assert {(r[GROUP], r[SEASON], r.id) for r in df.collect()} == {("m", 1, "1"), ("m", 2, "1")}


def test_jdbc_options():
    assert jdbc_options("postgresql+client://u:p%40s@h:6543/db?sslmode=require", schema="s") == {
        "url": "jdbc:postgresql://h:6543/db?stringtype=unspecified&sslmode=require",
        "driver": "org.postgresql.Driver",
        "currentSchema": "s",
        "user": "u",
        "password": "p@s",
    }
    coded = jdbc_options("postgresql://[::1]/db?options=a%26b%20c")
    assert coded["url"] == "jdbc:postgresql://[::1]:5432/db?stringtype=unspecified&options=a%26b%20c"
    plain = jdbc_options("postgresql:///db?stringtype=varchar")
    assert plain["url"] == "jdbc:postgresql://localhost:5432/db?stringtype=varchar"
    assert "user" not in plain and "password" not in plain
    with pytest.raises(ValueError, match="mysql"):
        jdbc_options("mysql://h/db")
    with pytest.raises(ValueError, match="database"):
        jdbc_options("postgresql://h")


def search_page(*ids):
    return json.dumps({"items": [{"id": {"videoId": i} if i else {}} for i in ids]})


def test_extract_video_ids(spark):
    pages = spark.createDataFrame(
        [
            (1, 0, search_page("b", None, "a", "")),
            (0, 1, search_page("d", "a")),
            (0, 0, search_page("c", "c", "b")),
            (2, 0, '{"items": [{"id": {"vid'),
            (3, 0, None),
            (4, 0, "{}"),
        ],
        "term_no int, page_no int, page string",
    )
    every = extract_video_ids(pages, per_term=None).orderBy("term_no", "page_no", "pos")
    assert [tuple(r) for r in every.collect()] == [("c", 0, 0, 0), ("b", 0, 0, 2), ("d", 0, 1, 0), ("a", 0, 1, 1)]
    # The cap counts results, also those without an id or seen before.
    capped = extract_video_ids(pages, per_term=3).orderBy("term_no", "pos")
    assert [r[0] for r in capped.collect()] == ["c", "b", "a"]
    many = spark.createDataFrame([(0, 0, search_page(*map(str, range(1, 100))))], "term_no int, page_no int, page string")
    assert extract_video_ids(many, per_term=80).count() == 80
    assert extract_video_ids(many).count() == 99
    for parsed in (extract_video_ids(many), extract_comments(many.select(F.lit("v").alias("video_id"), F.lit(0).alias("video_ord"), "page_no", "page"))):
        assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def comment_page(*items):
    return json.dumps({"items": list(items), "nextPageToken": "t"})


def comment(author=None, text=None, **item):
    shown = {"authorDisplayName": author, "textDisplay": text}
    snippet = {k: v for k, v in shown.items() if v is not None}
    return {**item, "snippet": {"topLevelComment": {"snippet": snippet}}}


def test_extract_comments(spark):
    pages = spark.createDataFrame(
        [
            ("v", 0, 0, comment_page(comment("ann", "hi é", id="1"), comment(), {})),
            ("v", 0, 1, comment_page(comment("bob", "x", id="2"))[:-5]),
            ("w", 1, 0, comment_page(comment("cy", "", id="3"))),
            ("w", 1, 1, json.dumps({"items": []})),
        ],
        "video_id string, video_ord int, page_no int, page string",
    )
    comments = extract_comments(pages)
    first = take_first(comments, 500, ["video_ord", "page_no", "pos"])
    assert [tuple(r)[:4] for r in first.collect()] == [
        ("v", "1", "ann", "hi é"),
        ("v", "", "unknown", ""),
        ("v", "", "unknown", ""),
        ("w", "3", "cy", ""),
    ]
    assert take_first(comments, 0, ["pos"]).count() == 0


def test_split_corrupt(spark):
    pages = spark.createDataFrame([(1, comment_page(comment(id="1"))), (2, '{"items": [{'), (3, None)], "n int, page string")
    good, bad = split_corrupt(pages, COMMENT_PAGE_SCHEMA)
    assert [r.n for r in good.collect()] == [1]
    assert sorted(r.n for r in bad.collect()) == [2, 3]
    assert "_corrupt_record" not in good.select("parsed.*").columns
    assert bad.columns == pages.columns
    good, bad = split_corrupt(pages, SEARCH_PAGE_SCHEMA)
    assert good.where(F.col("n") == 2).count() == 0
