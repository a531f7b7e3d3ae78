"""What the micro-batches of a stream write, and snapshots that take their place.

    {path}/batch_id=7/           the rows of one batch
    {path}/_snapshots/upto=6/    the rows of all batches up to 6, merged

A folder counts from the moment its writer marks it as done (``_SUCCESS``, which Spark writes
last unless it is told not to), so a writer may be lost at any step:

* before the mark of a batch: the stream runs the batch again, which replaces the folder;
* before the mark of a snapshot: readers go on with the one before and the batches behind it;
* while it deletes: only what an earlier snapshot holds already goes, and nothing reads it.

The newest snapshot is the high-water mark. Batches up to it are not read any more, and a batch
that a restarted stream runs again is not written once a snapshot holds it. One stream writes
to a path, and one compaction runs at a time; readers may come at any time, as the snapshot
before the newest and the batches between the two stay until the next compaction.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch_id"
_SNAPSHOTS, _UPTO = "_snapshots", "upto"

Merge = Callable[[DataFrame], DataFrame]


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _numbered(spark: SparkSession, path: str, label: str) -> dict[int, bool]:
    """Folders ``label=n`` below a path, and whether they are done."""
    store, folder = _store(spark, path)
    if not store.exists(folder):
        return {}
    found = {}
    for status in store.listStatus(folder):
        place = status.getPath()
        match = re.fullmatch(rf"{label}=(\d+)", place.getName())
        if match:
            done = spark._jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")
            found[int(match[1])] = bool(store.exists(done))
    return found


def high_water(spark: SparkSession, path: str) -> int:
    """The last batch that a snapshot holds; -1 if there is none."""
    snapshots = _numbered(spark, f"{path}/{_SNAPSHOTS}", _UPTO)
    return max((n for n, done in snapshots.items() if done), default=-1)


def open_batches(spark: SparkSession, path: str) -> list[int]:
    """The batches that are done and that no snapshot holds, in order."""
    mark = high_water(spark, path)
    return sorted(n for n, done in _numbered(spark, path, BATCH).items() if done and n > mark)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """The rows of a batch; what the batch wrote before is replaced."""
    if batch_id > high_water(df.sparkSession, path):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(
    spark: SparkSession, path: str, schema: str | StructType, upto: int | None = None
) -> DataFrame:
    """All rows so far, with the number of their batch, or of the last one of their snapshot.

    Only the newest snapshot and the batches behind it are read.
    """
    mark = high_water(spark, path)
    batches = [n for n in open_batches(spark, path) if upto is None or n <= upto]
    number = F.lit(mark).cast("bigint").alias(BATCH)
    empty = spark.createDataFrame([], schema).select("*", number)
    found = []
    if mark >= 0:
        snapshot = f"{path}/{_SNAPSHOTS}/{_UPTO}={mark}"
        found.append(spark.read.schema(schema).parquet(snapshot).select("*", number))
    if batches:
        reader = spark.read.schema(empty.schema).option("basePath", path)
        found.append(reader.parquet(*[f"{path}/{BATCH}={n}" for n in batches]))
    return reduce(DataFrame.unionByName, found) if found else empty


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the row of its last batch: what a stream that rewrites rows has arrived at."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(BATCH))
    ranked = rows.withColumn("__newest", F.row_number().over(newest))
    return ranked.where(F.col("__newest") == 1).drop("__newest", BATCH)


def compact(spark: SparkSession, path: str, schema: str | StructType, merge: Merge) -> int:
    """Merge what ``read_batches`` gives into a new snapshot; returns the high-water mark.

    ``merge`` takes those rows, with their batch numbers, and gives rows of ``schema``; merging
    merged rows with further ones has to be the same as merging all at once.
    """
    before = high_water(spark, path)
    batches = open_batches(spark, path)
    if not batches:
        return before
    mark = batches[-1]
    merged = merge(read_batches(spark, path, schema, upto=mark))
    merged.write.mode("overwrite").parquet(f"{path}/{_SNAPSHOTS}/{_UPTO}={mark}")
    # Readers that came before this snapshot still need the one before and what follows it.
    for label, below in ((BATCH, path), (_UPTO, f"{path}/{_SNAPSHOTS}")):
        for n in _numbered(spark, below, label):
            if n < before or (label == BATCH and n <= before):
                store, folder = _store(spark, f"{below}/{label}={n}")
                store.delete(folder, True)
    return mark
