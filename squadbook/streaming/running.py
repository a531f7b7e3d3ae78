"""Results over all of a stream that are right after every micro-batch.

Spark keeps a total, or a first place, for each key in its state. What changed in a batch is
written as that batch's rows, so a sink holds, for every key, its newest row; snapshots take
the place of old batches (``sinks.batches``). State and sink agree after a restart: the state
comes back with the checkpoint, and a batch that runs again replaces its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.mentions import (
    BROADCAST_BYTES,
    CANONICAL,
    MENTIONS,
    AliasTable,
    found_names,
    prepare_aliases,
)
from ..sinks.batches import compact, latest, open_batches, read_batches, write_batch
from ..sources.comments import extract_comments, video_places
from .comments import AVAILABLE_NOW

RUNNING_COUNTS = f"{CANONICAL} string, {MENTIONS} bigint"


def running_mentions(
    stream: DataFrame,
    aliases: DataFrame | AliasTable,
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    boundary: str = "word",
) -> DataFrame:
    """``canonical, mentions`` over all comments so far; every row is a comment.

    The state has a number for each name that was found. Names are added up in the tasks that
    find them, so a name in a third of all comments is a row a task.
    """
    table = aliases if isinstance(aliases, AliasTable) else prepare_aliases(aliases, boundary)
    found = found_names(stream, table, text, broadcast_bytes)
    return found.groupBy(CANONICAL).agg(F.count(F.lit(1)).alias(MENTIONS))


def running_first(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``, then by the other columns, of all so far.

    The state has a row for each key. A later batch may hold an earlier place, which then takes
    over, so the result is the batch one whatever the order in which rows come.
    """
    others = [c for c in stream.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *others)).alias("__first")
    found = stream.groupBy(*keys).agg(first)
    return found.select(*[f"__first.{c}" if c not in keys else c for c in stream.columns])


def stream_video_ids(search_pages: DataFrame) -> DataFrame:
    """Each video at its first place in the walk, from pages that come in any order."""
    places = video_places(search_pages).where(F.col("video_id") != "")
    return running_first(places, ["video_id"], ["term_no", "page_no", "pos"])


def stream_comments(comment_pages: DataFrame) -> DataFrame:
    """Each comment of a video at its first place: one for every id, however often pages come.

    Comments without an id are told apart by the page and place they stand at.
    """
    comments = extract_comments(comment_pages)
    unnamed = F.when(F.col("comment_id") == "", F.concat_ws("/", "page_no", "pos"))
    keyed = comments.withColumn("__unnamed", unnamed)
    keys = ["video_id", "comment_id", "__unnamed"]
    return running_first(keyed, keys, ["video_ord", "page_no", "pos"]).drop("__unnamed")


def write_running(
    running: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    trigger: dict | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Write the rows that each micro-batch changed; ``read_running`` has the newest of a key.

    With ``compact_every`` that many batches at a time are folded into a snapshot.
    """
    schema = running.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)
        if compact_every and len(open_batches(batch.sparkSession, path)) >= compact_every:
            compact_running(batch.sparkSession, path, schema, keys)

    writer = running.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def read_running(
    spark: SparkSession, path: str, schema: str | StructType, keys: Sequence[str]
) -> DataFrame:
    """The newest row of every key: the result over all batches that are done."""
    return latest(read_batches(spark, path, schema), keys)


def compact_running(
    spark: SparkSession, path: str, schema: str | StructType, keys: Sequence[str]
) -> int:
    """Fold the batches into a snapshot; returns the last batch it holds."""
    return compact(spark, path, schema, lambda rows: latest(rows, keys))
