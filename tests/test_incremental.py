"""Loads that read only what changed, and reports on a roster in buckets."""

import os
import time

import pytest

from squadbook.plans import build_roster, load_changed_seasons, nationality_histogram, read_roster
from squadbook.sinks import write_bucketed_roster
from squadbook.sources import ManifestError, SeasonFile, season_digests

HEADER = "sofifa_id,short_name,nationality_name"


def season(folder, group, year, rows, header=HEADER):
    file = folder / f"{group}_{year}.csv"
    file.write_text("\n".join([header, *rows]) + "\n")
    later = time.time() + len(os.listdir(folder)) + len(rows)
    os.utime(file, (later, later))
    return SeasonFile(group, year, str(file))


@pytest.fixture
def seasons(tmp_path):
    return [
        season(tmp_path, "male", 2021, ["1,A,X", "1,A again,X", "2,B,Y"]),
        season(tmp_path, "male", 2022, ["1,A,X", ",lost,Z"]),
        season(tmp_path, "female", 2022, ["7,F,Y"]),
    ]


def rows(df):
    columns = sorted(df.columns)
    return sorted(str([r[c] for c in columns]) for r in df.collect())


def files(path):
    return {
        os.path.join(where, name): os.path.getmtime(os.path.join(where, name))
        for where, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def test_only_changed_seasons_are_loaded(spark, tmp_path, path, seasons):
    target, places = f"{path}/players", (f"{path}/log", f"{path}/seasons")

    def load(manifest):
        done = load_changed_seasons(spark, manifest, target, *places, expected={})
        whole, _ = build_roster(spark, manifest, {})
        got = read_roster(spark, target)
        assert rows(got.select(whole.columns)) == rows(whole)
        return done

    first = load(seasons)
    assert first.row_count == 4 and len(first.loaded) == 3
    before = files(target)
    again = load(seasons)
    assert (again.loaded, again.removed, again.row_count) == ((), (), 0) and files(target) == before
    # A season changes and has a new column, another is new.
    seasons[1] = season(tmp_path, "male", 2022, ["1,A,W,90", "3,C,W,80"], HEADER + ",overall")
    seasons.append(season(tmp_path, "female", 2023, ["8,G,Y"]))
    done = load(seasons)
    assert done.loaded == (("female", 2023), ("male", 2022)) and done.row_count == 3
    kept = {f: t for f, t in files(target).items() if "year=2021" in f or "2022/gender=female" in f}
    assert kept and kept.items() <= before.items()
    # One goes, and one has no rows any more.
    del seasons[2]
    seasons[0] = season(tmp_path, "male", 2021, [])
    done = load(seasons)
    assert done.loaded == (("male", 2021),) and done.removed == (("female", 2022),)
    assert not [f for f in files(target) if "year=2021" in f or "2022/gender=female" in f]
    logged = spark.read.parquet(places[0])
    assert sorted(r.row_count for r in logged.collect()) == [0, 3, 4]


def test_a_load_that_was_cut_short_is_done_again(spark, path, seasons, monkeypatch):
    target, places = f"{path}/players", (f"{path}/log", f"{path}/seasons")

    def fail(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr("squadbook.plans.incremental.append_log", fail)
        with pytest.raises(OSError):
            load_changed_seasons(spark, seasons, target, *places, expected={})
    done = load_changed_seasons(spark, seasons, target, *places, expected={})
    assert len(done.loaded) == 3 and read_roster(spark, target).count() == 4


def test_groups_that_share_ids_are_loaded_together(spark, tmp_path, path, seasons):
    target, places = f"{path}/players", (f"{path}/log", f"{path}/seasons")
    mixed = season(tmp_path, "mixed", 2022, ["5,M,X"])
    load_changed_seasons(spark, [*seasons, mixed], target, *places, expected={})
    mixed = season(tmp_path, "mixed", 2022, ["5,M,X", "6,N,X"])
    done = load_changed_seasons(spark, [*seasons, mixed], target, *places, expected={})
    assert done.loaded == (("male", 2022), ("mixed", 2022))


def test_missing_seasons_and_files(spark, path, seasons):
    with pytest.raises(ManifestError):
        load_changed_seasons(spark, seasons, path, f"{path}/l", f"{path}/s", expected={"male": [1999]})
    with pytest.raises(FileNotFoundError):
        season_digests(spark, [SeasonFile("male", 2000, f"{path}/none.csv")])


def test_a_bucketed_roster_is_not_shuffled_by_entity(spark):
    entities = [(i % 300 if i % 3 else None, f"P{i}", 2015 + i % 5, "m", f"m{i}", f"N{i % 7}") for i in range(3000)]
    roster = spark.createDataFrame(
        entities, "sofifa_id bigint, short_name string, year int, gender string, player_id string, nationality_name string"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_bucketed_roster(roster, "bucketed_players", 8)
        table = spark.table("bucketed_players")
        assert table.count() == 3000
        histogram = nationality_histogram(table)
        plan = histogram._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(sofifa_id" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
        assert rows(histogram) == rows(nationality_histogram(roster))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_players")
