import json

from pyspark.sql import functions as F

from squadbook.operators import count_mentions
from squadbook.streaming import (
    read_comment_stream,
    read_mention_totals,
    stream_dedup,
    stream_mentions,
    stream_take,
    write_first,
)

TEXTS = ["messi messi", "Messi and Neymar", "nobody", "neymar!", "messis", "x. messi", ""]


def land(folder, start, texts):
    folder.mkdir(exist_ok=True)
    for i, text in enumerate(texts, start):
        record = {"video_id": "v", "comment_id": str(i), "author": "é", "text": text}
        (folder / f"{i}.json").write_text(json.dumps(record) + "\n")


def aliases(spark):
    return spark.createDataFrame([("messi", "M"), ("neymar", "N")], "alias string, canonical string")


def totals(df):
    return {r.canonical: r.mentions for r in df.collect()}


def test_stream_mentions_resumes_and_equals_batch(spark, tmp_path, path):
    landing = tmp_path / "landing"
    counts, dump, checkpoint = (f"{path}/{n}" for n in ("counts", "dump", "checkpoint"))

    def run(limit):
        stream = read_comment_stream(spark, str(landing), max_files=2)
        query = stream_mentions(
            stream, aliases(spark), counts, checkpoint, dump_path=dump, broadcast_bytes=limit
        )
        query.awaitTermination()
        return query

    land(landing, 0, TEXTS[:4])
    assert run(1 << 20).lastProgress["batchId"] == 1
    assert totals(read_mention_totals(spark, counts)) == {"M": 2, "N": 2}
    land(landing, 4, TEXTS[4:])
    run(0)
    batch = spark.read.schema("comment_id string, text string").json(str(landing))
    got = totals(read_mention_totals(spark, counts))
    assert got == totals(count_mentions(batch, aliases(spark))) == {"M": 3, "N": 2}
    dumped = spark.read.option("recursiveFileLookup", True).json(dump)
    assert sorted(r.text for r in dumped.collect()) == sorted(TEXTS)


def test_a_repeated_batch_replaces_its_output(spark, tmp_path, path):
    landing = tmp_path / "landing"
    land(landing, 0, TEXTS)
    for attempt in ("first", "second"):  # a lost checkpoint replays batch 0
        stream = read_comment_stream(spark, str(landing))
        stream_mentions(
            stream, aliases(spark), f"{path}/counts", f"{path}/{attempt}", dump_path=f"{path}/dump"
        ).awaitTermination()
    assert totals(read_mention_totals(spark, f"{path}/counts")) == {"M": 3, "N": 2}
    dumped = spark.read.option("recursiveFileLookup", True).json(f"{path}/dump")
    assert dumped.count() == len(TEXTS)


def test_a_repeated_id_counts_as_in_a_batch(spark, tmp_path, path):
    land(tmp_path / "landing", 0, ["messi"])
    (tmp_path / "landing" / "again.json").write_text((tmp_path / "landing" / "0.json").read_text())
    stream = read_comment_stream(spark, str(tmp_path / "landing"), max_files=1)
    stream_mentions(stream, aliases(spark), f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    batch = spark.read.schema("comment_id string, text string").json(str(tmp_path / "landing"))
    got = totals(read_mention_totals(spark, f"{path}/counts"))
    assert got == totals(count_mentions(batch, aliases(spark))) == {"M": 2}


def append(stream, path):
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    writer.outputMode("append").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/out")


def test_stream_dedup(spark, tmp_path, path):
    landing = tmp_path / "landing"
    land(landing, 0, ["hot"] * 6 + ["a", "b", "a"])
    for spread in ([], ["comment_id"]):
        stream = read_comment_stream(spark, str(landing), max_files=2)
        unique = append(stream_dedup(stream, ["text"], spread), f"{path}/{len(spread)}")
        assert sorted(r.text for r in unique.collect()) == ["a", "b", "hot"]
        assert set(unique.columns) == set(stream.columns)


def test_stream_take(spark, tmp_path, path):
    land(tmp_path / "landing", 0, TEXTS)
    stream = read_comment_stream(spark, str(tmp_path / "landing"), max_files=2)
    assert append(stream_take(stream, 3), path).agg(F.count("*")).first()[0] == 3


def test_write_first_stops(spark, tmp_path, path):
    land(tmp_path / "landing", 0, [f"t{i}" for i in range(30)])
    for _ in range(2):  # a restart finds what is written
        stream = read_comment_stream(spark, str(tmp_path / "landing"), max_files=1)
        assert write_first(stream, 3, f"{path}/rows", f"{path}/checkpoint") == 3
    assert spark.read.parquet(f"{path}/rows").select("text").distinct().count() == 3
    stream = read_comment_stream(spark, str(tmp_path / "landing"))
    assert write_first(stream, 100, f"{path}/all", f"{path}/checkpoint2") == 30
