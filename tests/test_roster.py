import json
import random

import pytest
from pyspark.sql import functions as F

from squadbook.operators import EmptyResultError
from squadbook.plans import (
    average_age_ranking,
    build_roster,
    expiring_contracts,
    load_roster,
    most_discussed_player,
    nationality_histogram,
    popular_nationality,
    standardize_roster,
)
from squadbook.schema import (
    CORE_COLUMNS,
    DOUBLE_COLUMNS,
    EXPECTED_SEASONS,
    REQUIRED_COLUMNS,
    TYPE_MAP,
)
from squadbook.sinks import (
    dump_comments,
    ensure_database,
    log_ingestion,
    write_roster,
    write_roster_chunks,
)
from squadbook.sources import SeasonFile, read_comments

SEASONS = {
    ("male", 2021): (
        "Sofifa ID,Short Name,Long Name,Age,Club,Nationality,Value (EUR),DOB,Contract\n"
        "158023,L. Messi,Lionel Andrés Messi,33,FC A,Argentina,78000000.0,1987-06-24,2021\n"
        "158023,L. Messi (copy),,33,FC B,Argentina,1,1987-06-24,2021\n"
        "190871,Neymar Jr,Neymar da Silva,28.0,FC B,Brazil,€90.5M,,\"Jun 30, 2022\"\n"
        ",No Key,,20,FC C,Spain,5,,2023\n"
        ",No Key Either,,21,FC C,Spain,5,,2023\n"
    ),
    ("male", 2022): (
        "sofifa_id,short_name,long_name,age,club_name,nationality_name,pace,contract_valid_until,preferred_foot\n"
        "158023,L. Messi,Lionel Andrés Messi,34,FC A,Argentina,85,2023,Left\n"
        "190871,Neymar Jr,Neymar da Silva,29,FC A,Brazil,72+3,2025,Right\n"
        "231747,K. Mbappé,Kylian Mbappé,22,FC B,France,97,2022,Right\n"
    ),
    ("female", 2022): (
        "player_url,name,full_name,nationality\n"
        "https://x/player/226301/alex/220069,A. Morgan,Alexandra Morgan,United States\n"
        "https://x/none,Nobody,,Norway\n"
    ),
}
EXPECTED = {"male": [2021, 2022], "female": [2022]}


@pytest.fixture(scope="module")
def manifest(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    entries = []
    for (group, year), text in SEASONS.items():
        file = folder / f"{group}_{year}.csv"
        file.write_text(text)
        entries.append(SeasonFile(group, year, str(file)))
    return entries


@pytest.fixture(scope="module")
def roster(spark, manifest):
    return build_roster(spark, manifest, EXPECTED)[0]


def test_schema_values():
    assert len(DOUBLE_COLUMNS) == len(set(DOUBLE_COLUMNS)) == 82
    assert len(TYPE_MAP) == 90
    assert len(REQUIRED_COLUMNS) == 16
    assert sum(map(len, EXPECTED_SEASONS.values())) == 15


def test_build_roster(spark, manifest, ansi):
    roster, rejected = build_roster(spark, manifest, EXPECTED)
    rows = [r.asDict() for r in roster.collect()]
    assert [r["player_id"] for r in rows] == [
        "M_2021_158023",
        "M_2021_190871",
        "F_2022_226301",
        "M_2022_158023",
        "M_2022_190871",
        "M_2022_231747",
    ]
    assert roster.columns[: len(CORE_COLUMNS)] == CORE_COLUMNS
    assert roster.columns[len(CORE_COLUMNS) :] == sorted(roster.columns[len(CORE_COLUMNS) :])
    assert set(REQUIRED_COLUMNS) <= set(roster.columns)
    types = dict(roster.dtypes)
    assert all(types[c] == TYPE_MAP.get(c, "string") for c in REQUIRED_COLUMNS)
    assert types["pace"] == "double" and types["dob"] == "timestamp" and types["preferred_foot"] == "string"

    messi, neymar = rows[0], rows[1]
    assert messi["short_name"] == "L. Messi" and messi["value_eur"] == 78000000.0
    assert messi["club_name"] == "FC A" and str(messi["dob"]) == "1987-06-24 00:00:00"
    assert messi["contract_valid_until"] == 2021
    assert neymar["value_eur"] == 90.5 and neymar["age"] == 28 and neymar["dob"] is None
    assert neymar["contract_valid_until"] is None
    morgan = rows[2]
    assert (morgan["sofifa_id"], morgan["short_name"], morgan["long_name"]) == (226301, "A. Morgan", "Alexandra Morgan")
    assert morgan["name"] == "A. Morgan" and morgan["age"] is None
    assert rows[4]["pace"] == 72.0
    assert sorted(r["short_name"] for r in rejected.collect()) == ["No Key", "No Key Either", "Nobody"]


def test_standardize_roster(spark, manifest):
    raw = spark.read.csv(manifest[0].path, header=True)
    season = standardize_roster(raw, 2021, "Male")
    ids = [r.player_id for r in season.collect()]
    assert sorted(ids, key=str) == ["M_2021_158023", "M_2021_190871", None]


def test_reports(roster):
    assert [tuple(r) for r in expiring_contracts(roster, 2022, 5, 2023).collect()] == [("FC A", 2, 1)]
    assert [tuple(r) for r in average_age_ranking(roster, 2022, 5).collect()] == [("FC A", 31.5, 1), ("FC B", 22.0, 2)]
    popular = [tuple(r) for r in popular_nationality(roster).collect()]
    assert popular == [(2021, "Argentina", 1, 1), (2022, "Argentina", 1, 1)]
    assert [tuple(r) for r in nationality_histogram(roster).collect()] == [
        ("Argentina", 1), ("Brazil", 1), ("France", 1), ("United States", 1),
    ]


def test_most_discussed_player(spark, roster):
    comments = spark.createDataFrame(
        [("v", "1", "a", "Lionel Andrés Messi or K. MBAPPÉ?"), ("v", "2", "b", "l. messi"), ("v", "3", "c", "")],
        "video_id string, comment_id string, author string, text string",
    )
    found = sorted(tuple(r) for r in most_discussed_player(roster, comments).collect())
    assert found == [("L. Messi", 2, "K. Mbappé", 1), ("L. Messi", 2, "L. Messi", 2)]
    with pytest.raises(EmptyResultError, match="1999"):
        most_discussed_player(roster, comments, year=1999)
    with pytest.raises(EmptyResultError, match="mentions"):
        most_discussed_player(roster, comments.where("comment_id = '3'"))


def test_load_roster_logs_what_it_wrote(spark, manifest, path):
    target, log = f"{path}/roster", f"{path}/log"
    assert load_roster(spark, manifest, target, log, EXPECTED) == 6
    stored = spark.read.parquet(target)
    assert stored.count() == 6
    log_ingestion(stored.select(*build_roster(spark, manifest, EXPECTED)[0].columns), manifest, log)
    records = spark.read.parquet(log).orderBy("ingested_at").collect()
    assert len(records) == 2 and records[0].ingested_at < records[1].ingested_at
    for record in records:
        assert (record.row_count, record.years) == (6, [2021, 2022])
        assert json.loads(record.source_files)["female"] == {"2022": manifest[2].path}
    assert records[0].checksum == records[1].checksum


def small(spark, *rows):
    return spark.createDataFrame(rows, "player_id string, year int, gender string, v int")


def content(spark, path):
    return sorted((r.player_id, r.year, r.gender, r.v) for r in spark.read.parquet(path).collect())


def test_write_roster_modes(spark, path):
    write_roster(small(spark, ("a", 1, "m", 1), ("b", 2, "m", 2)), f"{path}/t")
    write_roster(small(spark, ("c", 2, "m", 3)), f"{path}/t", "replace_seasons")
    assert content(spark, f"{path}/t") == [("a", 1, "m", 1), ("c", 2, "m", 3)]
    write_roster(small(spark, ("d", 2, "m", 4)), f"{path}/t", "append")
    assert len(content(spark, f"{path}/t")) == 3
    write_roster(small(spark, ("e", 3, "f", 5)), f"{path}/t")
    assert content(spark, f"{path}/t") == [("e", 3, "f", 5)]
    with pytest.raises(ValueError):
        write_roster(small(spark, ("e", 3, "f", 5)), f"{path}/t", "merge")


def test_write_roster_to_a_table_keeps_its_definition(spark):
    ensure_database(spark, "squad")
    ensure_database(spark, "squad")
    try:
        write_roster(small(spark, ("a", 1, "m", 1)), "squad.players")
        before = spark.table("squad.players").schema
        write_roster(small(spark, ("b", 2, "f", 2)).select("v", "year", "gender", "player_id"), "squad.players")
        table = spark.table("squad.players")
        assert table.schema == before
        assert [(r.player_id, r.year, r.gender, r.v) for r in table.collect()] == [("b", 2, "f", 2)]
    finally:
        spark.sql("DROP DATABASE squad CASCADE")


def test_a_hot_season_is_written_by_many_tasks(spark, path):
    rng = random.Random(3)
    rows = [(f"p{rng.random()}", 1, "m", i) for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_roster(small(spark, *rows), f"{path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(f"{path}/t").groupBy(F.input_file_name()).count().collect()
    assert 2 <= len(files) <= 16 and max(f["count"] for f in files) < 2500


@pytest.mark.parametrize("table", [False, True])
def test_a_failed_replace_leaves_the_old_roster(spark, path, table):
    target = f"{path}/t"
    if table:
        ensure_database(spark, "safe")
        target = "safe.players"
    try:
        for _ in range(2):  # the second write meets what the first made
            write_roster(small(spark, ("a", 1, "m", 1)), target)
        fail = F.raise_error(F.lit("lost on the way")).cast("int")
        broken = small(spark, *[(f"b{i}", 1, "m", i) for i in range(50)])
        broken = broken.withColumn("v", F.when(F.col("v") == 40, fail).otherwise(F.col("v")))
        for write in (write_roster, lambda df, t: write_roster_chunks([df, small(spark, ("c", 1, "m", 1))], t)):
            with pytest.raises(Exception, match="lost on the way"):
                write(broken, target)
            rows = spark.table(target) if table else spark.read.parquet(target)
            assert [(r.player_id, r.v) for r in rows.collect()] == [("a", 1)]
    finally:
        if table:
            spark.sql("DROP DATABASE safe CASCADE")


@pytest.mark.parametrize("infer", [False, True])
def test_ids_as_doubles_and_exponents_are_kept(spark, tmp_path, infer):
    (tmp_path / "a.csv").write_text("sofifa_id,short_name\n12345678.0,A\n1.2345679E7,B\nnone,C\n")
    manifest = [SeasonFile("m", 2021, str(tmp_path / "a.csv"))]
    kept, rejected = build_roster(spark, manifest, {"m": [2021]}, infer=infer)
    assert {(r.sofifa_id, r.short_name) for r in kept.collect()} == {(12345678, "A"), (12345679, "B")}
    assert [r.short_name for r in rejected.collect()] == ["C"]


def test_one_scan_for_each_header(spark, tmp_path):
    """Files of one folder go by name, also in another order; seasons share a scan."""
    manifest = []
    for year in range(2001, 2013):
        folder = tmp_path / str(year)
        folder.mkdir()
        (folder / "a.csv").write_text(f"sofifa_id,short_name,age\n{year},A{year},20\n")
        (folder / "b.csv").write_text(f"age,sofifa_id,short_name\n30,{year * 10},B{year}\n")
        manifest.append(SeasonFile("M", year, str(folder)))
    roster, _ = build_roster(spark, manifest, {"M": [2001]})
    plan = roster._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 2
    rows = {(r.year, r.gender, r.sofifa_id, r.short_name, r.age) for r in roster.collect()}
    assert rows == {(y, "m", y, f"A{y}", 20) for y in range(2001, 2013)} | {
        (y, "m", y * 10, f"B{y}", 30) for y in range(2001, 2013)
    }


def test_write_roster_chunks(spark, path):
    first, second = small(spark, ("a", 1, "m", 1)), small(spark, ("b", 2, "m", 2)).drop("v")
    write_roster_chunks(iter([first, second]), f"{path}/t")
    assert content(spark, f"{path}/t") == [("a", 1, "m", 1), ("b", 2, "m", None)]
    with pytest.raises(ValueError):
        write_roster_chunks([], f"{path}/t")
    with pytest.raises(TypeError):
        write_roster_chunks([first, "no frame"], f"{path}/t")
    assert len(content(spark, f"{path}/t")) == 2


def test_dump_comments(spark, path):
    comments = spark.createDataFrame(
        [("v", "1", "é", "Ünï \"q\"\n2"), ("v", "2", None, "")],
        "video_id string, comment_id string, author string, text string",
    )
    dump_comments(comments.limit(1), path)
    dump_comments(comments, path)
    assert sorted(map(tuple, read_comments(spark, path).collect())) == sorted(map(tuple, comments.collect()))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert any("Ünï" in line for line in lines)
    assert all(list(json.loads(line)) == comments.columns for line in lines)
