"""Results that are kept while a stream runs: equal to the batch after every micro-batch."""

import glob
import json
import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from squadbook import sources, streaming
from squadbook.functions import ingestion_metrics
from squadbook.operators import count_mentions, prepare_aliases
from squadbook.plans.table_queries import _landed
from squadbook.runtime import scratch_made
from squadbook.schema import COMMENT_PAGE_SCHEMA, COMMENT_SCHEMA
from squadbook.sinks import compact, high_water, open_batches, read_batches, write_batch

COUNTS = "canonical string, mentions bigint"
TEXTS = ["messi messi", "Messi and Neymar", "nobody", "neymar!", "x. messi", "", "the pulga of rosario, he"]


def added(rows):
    return rows.groupBy("canonical").agg(F.sum("mentions").alias("mentions"))


def totals(df):
    return {r.canonical: r.mentions for r in df.collect()}


def counts(spark, path):
    return totals(added(read_batches(spark, path, COUNTS)))


def batch(spark, **named):
    return spark.createDataFrame(list(named.items()), COUNTS)


def land(folder, start, texts, seconds=None):
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(texts, start):
        file = folder / f"{i:04}.json"
        file.write_text(json.dumps({"video_id": "v", "comment_id": str(i), "author": "é", "text": text}) + "\n")
        # Files are read in the order in which they were written.
        written = 1_700_000_000 + (i if seconds is None else seconds)
        os.utime(file, (written, written))


def aliases(spark):
    long = "the pulga of rosario, he"
    rows = [("messi", "M"), ("neymar", "N"), (long, "M"), (long + "ro of all", "H")]
    return spark.createDataFrame(rows, "alias string, canonical string")


# Batches and snapshots


def test_a_snapshot_takes_the_place_of_batches(spark, path):
    for i, rows in enumerate([{"a": 1}, {"a": 2, "b": 1}, {"b": 5}]):
        write_batch(batch(spark, **rows), path, i)
    assert high_water(spark, path) == -1 and counts(spark, path) == {"a": 3, "b": 6}
    assert compact(spark, path, COUNTS, added) == 2
    assert open_batches(spark, path) == [] and counts(spark, path) == {"a": 3, "b": 6}
    write_batch(batch(spark, a=10), path, 3)
    assert open_batches(spark, path) == [3] and counts(spark, path) == {"a": 13, "b": 6}
    # A batch that a snapshot holds is not written again, one behind it is replaced.
    write_batch(batch(spark, a=100), path, 1)
    write_batch(batch(spark, a=20), path, 3)
    assert counts(spark, path) == {"a": 23, "b": 6}
    assert compact(spark, path, COUNTS, added) == 3
    assert compact(spark, path, COUNTS, added) == 3  # nothing left to do
    assert counts(spark, path) == {"a": 23, "b": 6}


def test_what_is_read_does_not_grow_with_the_batches(spark, path):
    for i in range(6):
        write_batch(batch(spark, a=1), path, i)
        if i % 2:
            compact(spark, path, COUNTS, added)
            assert read_batches(spark, path, COUNTS).count() == 1
    # Behind a compaction only what readers of the snapshot before may need is left.
    assert sorted(os.listdir(path)) == ["_snapshots", "batch_id=4", "batch_id=5"]
    assert sorted(os.listdir(f"{path}/_snapshots")) == ["upto=3", "upto=5"]


def test_a_writer_may_be_lost_at_any_step(spark, path):
    for i in range(3):
        write_batch(batch(spark, a=1), path, i)
    wanted = {"a": 3}
    # A batch that is being written.
    shutil.copytree(f"{path}/batch_id=2", f"{path}/batch_id=3")
    os.remove(f"{path}/batch_id=3/_SUCCESS")
    assert counts(spark, path) == wanted
    # A snapshot that is being written.
    shutil.copytree(f"{path}/batch_id=2", f"{path}/_snapshots/upto=2")
    os.remove(f"{path}/_snapshots/upto=2/_SUCCESS")
    assert counts(spark, path) == wanted
    # A snapshot that is done, and nothing deleted yet; then a part of it.
    shutil.copytree(path, f"{path}-copy")
    assert compact(spark, path, COUNTS, added) == 2
    for i in range(3):
        shutil.copytree(f"{path}-copy/batch_id={i}", f"{path}/batch_id={i}", dirs_exist_ok=True)
    assert counts(spark, path) == wanted
    shutil.rmtree(f"{path}/batch_id=1")
    assert counts(spark, path) == wanted
    write_batch(batch(spark, a=1), path, 3)
    assert compact(spark, path, COUNTS, added) == 3 and counts(spark, path) == {"a": 4}


def test_nothing_written_yet(spark, path):
    assert read_batches(spark, path, COUNTS).collect() == []
    assert compact(spark, path, COUNTS, added) == -1


def test_stream_mentions_with_snapshots(spark, tmp_path, path):
    landing = tmp_path / "landing"
    land(landing, 0, TEXTS)
    stream = streaming.read_comment_stream(spark, str(landing), max_files=1)
    streaming.stream_mentions(
        stream, aliases(spark), f"{path}/counts", f"{path}/checkpoint", compact_every=3
    ).awaitTermination()
    assert high_water(spark, f"{path}/counts") == 5 and open_batches(spark, f"{path}/counts") == [6]
    comments = spark.read.schema(COMMENT_SCHEMA).json(str(landing))
    wanted = totals(count_mentions(comments, aliases(spark)))
    assert totals(streaming.read_mention_totals(spark, f"{path}/counts")) == wanted
    assert streaming.compact_mentions(spark, f"{path}/counts") == 6
    assert totals(streaming.read_mention_totals(spark, f"{path}/counts")) == wanted == {"M": 4, "N": 2}


# Running counts


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("compact_every", [None, 2])
def test_running_mentions_are_right_after_every_batch(spark, tmp_path, path, limit, compact_every):
    landing = tmp_path / "landing"
    table = prepare_aliases(aliases(spark))
    for start in range(0, len(TEXTS), 2):  # every round is a restart
        land(landing, start, TEXTS[start : start + 2])
        stream = streaming.read_comment_stream(spark, str(landing), max_files=1)
        running = streaming.running_mentions(stream, table, broadcast_bytes=limit)
        streaming.write_running(
            running, f"{path}/totals", f"{path}/checkpoint", ["canonical"], compact_every=compact_every
        ).awaitTermination()
        got = streaming.read_running(spark, f"{path}/totals", streaming.RUNNING_COUNTS, ["canonical"])
        comments = spark.read.schema(COMMENT_SCHEMA).json(str(landing))
        assert totals(got) == totals(count_mentions(comments, table))
    assert totals(got) == {"M": 4, "N": 2}
    assert (high_water(spark, f"{path}/totals") >= 0) == (compact_every is not None)


def test_a_batch_that_runs_again_counts_once(spark, tmp_path, path):
    """The last batch was written, but the checkpoint does not know that it is done."""
    landing = tmp_path / "landing"
    table = prepare_aliases(aliases(spark), "loose")

    def run():
        stream = streaming.read_comment_stream(spark, str(landing), max_files=2)
        running = streaming.running_mentions(stream, table)
        streaming.write_running(running, f"{path}/totals", f"{path}/checkpoint", ["canonical"]).awaitTermination()
        return totals(streaming.read_running(spark, f"{path}/totals", streaming.RUNNING_COUNTS, ["canonical"]))

    land(landing, 0, TEXTS[:4])
    first = run()
    commits = f"{path}/checkpoint/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    os.remove(f"{commits}/{last}")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.remove(f"{commits}/.{last}.crc")
    assert run() == first == {"M": 2, "N": 2}
    land(landing, 4, TEXTS[4:])
    assert run() == {"M": 4, "N": 2}


# De-duplication with an end


def deduped(spark, landing, path, max_files=1, **how):
    stream = streaming.read_comment_stream(spark, str(landing), max_files=max_files, arrival="arrived_at")
    unique = streaming.stream_dedup(stream, ["text"], arrival="arrived_at", **how)
    writer = unique.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    query = writer.outputMode("append").trigger(availableNow=True).start(f"{path}/out")
    query.awaitTermination()
    states = [max((s["numRowsTotal"] for s in p["stateOperators"]), default=0) for p in query.recentProgress]
    return Counter(r.text for r in spark.read.parquet(f"{path}/out").collect()), states


@pytest.mark.parametrize("spread_by", [[], ["comment_id"]])
def test_the_state_levels_off(spark, tmp_path, path, spread_by):
    # A file a minute, with a text of its own; each text comes again two minutes later.
    for i in range(20):
        land(tmp_path / "in", 2 * i, [f"t{i}", f"t{i - 2}"], seconds=60 * i)
    got, states = deduped(spark, tmp_path / "in", path, max_files=2, within="5 minutes", spread_by=spread_by)
    assert got == Counter({f"t{i}": 1 for i in range(-2, 20)})
    # All keys would be 22 rows, and 40 where they are thinned in parts first.
    assert max(states) <= (26 if spread_by else 13)


def test_late_repeats(spark, tmp_path, path):
    land(tmp_path / "in", 0, ["a"], seconds=0)
    land(tmp_path / "in", 1, ["a"], seconds=100)  # within the time
    land(tmp_path / "in", 2, ["b"], seconds=1000)
    land(tmp_path / "in", 3, ["c"], seconds=1001)
    land(tmp_path / "in", 4, ["a"], seconds=1002)  # forgotten by now: a first row again
    got, _ = deduped(spark, tmp_path / "in", path, within="2 minutes")
    assert got == {"a": 2, "b": 1, "c": 1}
    with pytest.raises(ValueError):
        streaming.stream_dedup(spark.range(1), ["id"], within="1 hour")


# Pages as a stream


def result(*ids):
    return json.dumps({"items": [{"id": {"videoId": i}} for i in ids]})


SEARCH = [
    (0, 0, result("a", "b", "", "a")),
    (0, 1, result("c", "b")),
    (1, 0, result("d", "a")),
    (1, 1, '{"items": [{"id"'),
    (1, 2, None),
    (2, 0, result()),
    (2, 1, result("e", "c", "f")),
]


def comment(i, text):
    snippet = {"topLevelComment": {"snippet": {"authorDisplayName": "x", "textDisplay": text}}}
    return {"id": i, "snippet": snippet}


def comments_page(*rows):
    return json.dumps({"items": [comment(*r) for r in rows]})


COMMENTS = [
    ("v", 0, 0, comments_page(("1", "one"), ("2", "two"))),
    ("v", 0, 1, comments_page(("2", "two"), ("3", "three"), ("", "no id"), ("", "no id"))),
    ("w", 1, 0, comments_page(("1", "of another video"))),
    ("w", 1, 1, "{"),
]


def page_stream(spark, rows, schema, folder, max_files):
    for i, row in enumerate(rows):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(folder)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("max_files", [1, 3])
def test_video_ids_equal_the_batch_whatever_the_cut(spark, path, step, max_files):
    schema = "term_no int, page_no int, page string"
    pages = page_stream(spark, SEARCH[::step], schema, f"{path}/pages", max_files)
    ids = streaming.stream_video_ids(pages)
    streaming.write_running(ids, f"{path}/ids", f"{path}/checkpoint", ["video_id"], compact_every=2).awaitTermination()
    got = streaming.read_running(spark, f"{path}/ids", ids.schema, ["video_id"])
    wanted = sources.extract_video_ids(spark.createDataFrame(SEARCH, schema))
    assert got.columns == wanted.columns
    assert sorted(got.collect()) == sorted(wanted.collect()) and got.count() == 6


@pytest.mark.parametrize("step", [1, -1])
def test_comments_of_repeated_pages_come_once(spark, path, step):
    schema = "video_id string, video_ord int, page_no int, page string"
    landed = (COMMENTS + COMMENTS[:2])[::step]
    comments = streaming.stream_comments(page_stream(spark, landed, schema, f"{path}/pages", 2))
    keys = ["video_id", "comment_id", "page_no", "pos"]
    query = streaming.write_running(comments, f"{path}/out", f"{path}/checkpoint", keys)
    query.awaitTermination()
    got = streaming.read_running(spark, f"{path}/out", comments.schema, ["video_id", "comment_id", "text"])
    assert sorted((r.video_id, r.comment_id, r.text) for r in got.collect()) == [
        ("v", "", "no id"),
        ("v", "1", "one"),
        ("v", "2", "two"),
        ("v", "3", "three"),
        ("w", "1", "of another video"),
    ]
    every = streaming.read_running(spark, f"{path}/out", comments.schema, keys)
    places = {(r.comment_id, r.page_no, r.pos) for r in every.where("video_id = 'v'").collect()}
    assert {("", 1, 2), ("", 1, 3), ("2", 0, 1)} <= places


# Quarantine


@pytest.mark.parametrize("max_files", [1, 4])
def test_broken_pages_land_apart(spark, path, max_files):
    schema = "video_id string, video_ord int, page_no int, page string"
    out = f"{path}/out"
    for attempt in ("first", "second"):  # a lost checkpoint: batches are replaced
        pages = page_stream(spark, COMMENTS if attempt == "first" else [], schema, f"{path}/pages", max_files)
        streaming.stream_split_corrupt(pages, COMMENT_PAGE_SCHEMA, out, f"{path}/{attempt}").awaitTermination()
    good = streaming.read_good_pages(spark, out, schema, COMMENT_PAGE_SCHEMA)
    broken = streaming.read_broken_pages(spark, out, schema, COMMENT_PAGE_SCHEMA)
    assert [(r.video_id, r.page_no, r.page) for r in broken.collect()] == [("w", 1, "{")]
    sizes = {(r.video_id, r.page_no): r.n for r in good.withColumn("n", F.size("parsed.items")).collect()}
    assert sizes == {("v", 0): 2, ("v", 1): 4, ("w", 0): 1}
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(broken" in plan


# Metrics


def test_every_batch_is_logged_once(spark, tmp_path, path):
    landing = tmp_path / "landing"
    schema = "player_id string, year int"
    rows = [("a", 2020), ("b", 2021), ("c", 2021), ("d", 2022)]
    for i, row in enumerate(rows):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(landing))
    log = streaming.BatchLog(spark, "load", f"{path}/log")
    spark.streams.addListener(log)
    try:
        for attempt in ("first", "second"):  # repeats replace records
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(str(landing))
            watched = streaming.observed(stream, "load")
            writer = watched.writeStream.format("parquet").option("checkpointLocation", f"{path}/{attempt}")
            query = writer.trigger(availableNow=True).start(f"{path}/{attempt}-rows")
            query.awaitTermination()
            assert log.wait(query)
    finally:
        spark.streams.removeListener(log)
    records = streaming.read_batch_log(spark, f"{path}/log").orderBy("batch_id").collect()
    assert [(r.batch_id, r.row_count) for r in records] == [(0, 3), (1, 1)]
    assert sorted(y for r in records for y in r.years) in ([2020, 2021, 2022], [2020, 2021, 2021, 2022])
    whole = spark.createDataFrame(rows, schema)
    checksum = whole.agg(*ingestion_metrics(whole)).first()["checksum"]
    assert sum(int(r.checksum) for r in records) == int(checksum)


def test_landed_files_follow_the_splits_of_the_input(spark, path):
    """A task writes no more than a split of the table, and the micro-batches stay as many."""
    table = spark.range(900).withColumn("text", F.repeat(F.lit("x"), 40)).repartition(9)
    table.write.parquet(f"{path}/table")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        rows = spark.read.parquet(f"{path}/table")
        splits = rows.rdd.getNumPartitions()
        stream = _landed(rows, "landed-test")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    landing = [p for p in scratch_made(spark) if "landed-test" in p][-1].removeprefix("file:")
    assert len(glob.glob(f"{landing}/part-*")) >= splits > 4
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    query = query.trigger(availableNow=True).start(f"{path}/out")
    query.awaitTermination()
    assert len(glob.glob(f"{path}/checkpoint/commits/[0-9]*".removeprefix("file:"))) == 4
    assert sorted(r.id for r in spark.read.parquet(f"{path}/out").collect()) == list(range(900))
