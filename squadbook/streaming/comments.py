"""Mention counts over a stream of comments, batch by batch, and its first rows.

Mention counts hold no state: every micro-batch writes its own counts, and snapshots take the
place of old batches (``sinks.batches``). ``running`` has counts that are kept in state.
Comments carry no event time; the time their file arrived is one to watermark by.
"""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.mentions import (
    BROADCAST_BYTES,
    CANONICAL,
    MENTIONS,
    AliasTable,
    count_mentions,
    prepare_aliases,
)
from ..schema import COMMENT_SCHEMA
from ..sinks.batches import BATCH as _BATCH
from ..sinks.batches import compact, open_batches, read_batches, write_batch

_COUNTS = f"{CANONICAL} string, {MENTIONS} bigint"
_SALT = "__salt"
_SALTS = 32

AVAILABLE_NOW = {"availableNow": True}


def read_comment_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = COMMENT_SCHEMA,
    max_files: int | None = None,
    file_format: str = "json",
    arrival: str | None = None,
) -> DataFrame:
    """Comments as they land in a folder; ``max_files`` bounds one micro-batch.

    ``arrival`` names a further column with the time at which a row's file was written.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path)
    if arrival is None:
        return rows
    return rows.select("*", F.col("_metadata.file_modification_time").alias(arrival))


def stream_mentions(
    stream: DataFrame,
    aliases: DataFrame | AliasTable,
    counts_path: str,
    checkpoint: str,
    dump_path: str | None = None,
    key: Sequence[str] | None = None,
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    trigger: dict | None = None,
    boundary: str = "word",
    compact_every: int | None = None,
) -> StreamingQuery:
    """Count each micro-batch on its own and write its counts, and its comments if asked.

    A batch is counted like a table by ``count_mentions``, whatever the size of the alias
    table. Every row is a comment, as in the batch count; with ``key`` rows with equal values
    are one comment within a batch, but not across batches. Both outputs go to folders named
    by batch, so a repeated batch replaces what it wrote before. ``read_mention_totals``
    adds the batches up. With a dump the comments are counted from it: a batch is read once.
    With ``compact_every`` that many batches at a time are added up to a snapshot of the totals.
    """
    # Stored once: every micro-batch reads the table again.
    table = aliases if isinstance(aliases, AliasTable) else prepare_aliases(aliases, boundary)

    def write(batch: DataFrame, batch_id: int) -> None:
        if dump_path is not None:
            dumped = f"{dump_path}/{_BATCH}={batch_id}"
            batch.write.mode("overwrite").option("ignoreNullFields", "false").json(dumped)
            batch = batch.sparkSession.read.schema(batch.schema).json(dumped)
        counts = count_mentions(batch, table, key, text, broadcast_bytes)
        write_batch(counts, counts_path, batch_id)
        if compact_every and len(open_batches(batch.sparkSession, counts_path)) >= compact_every:
            compact_mentions(batch.sparkSession, counts_path)

    writer = stream.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(
        **(trigger or AVAILABLE_NOW)
    ).start()


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy(CANONICAL).agg(F.sum(MENTIONS).alias(MENTIONS))


def read_mention_totals(spark: SparkSession, counts_path: str) -> DataFrame:
    """``canonical, mentions`` over all batches written so far, from a snapshot as far as it goes."""
    return _added_up(read_batches(spark, counts_path, _COUNTS))


def compact_mentions(spark: SparkSession, counts_path: str) -> int:
    """Add the batches up to a snapshot of the totals; returns the last batch it holds."""
    return compact(spark, counts_path, _COUNTS, _added_up)


def stream_dedup(
    stream: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str] = (),
    arrival: str | None = None,
    within: str | None = None,
) -> DataFrame:
    """One row per key over the whole stream, or ``within`` a time such as ``"2 hours"``.

    Over the whole stream the state grows with the keys. With ``within``, and a timestamp column
    ``arrival``, a key is forgotten once the watermark, the latest arrival less that time, has
    passed its kept row by that time, so the state holds the keys of a bounded stretch of time.
    A repeat that comes before is dropped; one that comes after is a first row again; a row
    older than the watermark is too late to be told and is dropped.

    With ``spread_by`` rows of a key are first thinned in parts, by a hash of these
    columns, so that a hot key passes through many tasks instead of one.
    """
    if (arrival is None) != (within is None):
        raise ValueError("arrival and within go together")
    if within is not None:
        stream = stream.withWatermark(arrival, within)

    def first(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.dropDuplicates(by) if within is None else rows.dropDuplicatesWithinWatermark(by)

    if not spread_by:
        return first(stream, list(keys))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(_SALTS))
    thinned = first(stream.withColumn(_SALT, salt), [*keys, _SALT])
    return first(thinned.drop(_SALT), list(keys))


def stream_take(stream: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows to arrive; for append and complete output.

    The query itself runs on after them; ``write_first`` stops it.
    """
    return stream.limit(n)


def write_first(stream: DataFrame, n: int, path: str, checkpoint: str, trigger: dict | None = None) -> int:
    """Write the first ``n`` rows to arrive as Parquet, and stop reading; returns their number.

    A row for each micro-batch is counted as it is written, under its number, so a repeated
    batch replaces its rows and the count is right after a restart.
    """
    spark = stream.sparkSession
    full = Event()

    def written() -> dict[int, int]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return {}
        rows = spark.read.parquet(path).groupBy(_BATCH).count().collect()
        return {r[_BATCH]: r["count"] for r in rows}

    counts = written()

    def write(batch: DataFrame, batch_id: int) -> None:
        missing = n - sum(c for k, c in counts.items() if k != batch_id)
        if missing > 0:
            folder = f"{path}/{_BATCH}={batch_id}"
            batch.limit(missing).write.mode("overwrite").parquet(folder)
            counts[batch_id] = spark.read.parquet(folder).count()
        if sum(counts.values()) >= n:
            full.set()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = writer.trigger(**(trigger or AVAILABLE_NOW)).start()
    while not query.awaitTermination(0.05):
        if full.is_set():
            query.stop()
    return sum(counts.values())
