"""Roster tables and comment dumps."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import ingestion_metrics
from ..operators.align import union_rosters
from ..runtime import stored
from ..schema import ENTITY_KEY, GENDER, SORT_COLUMNS, YEAR

# Over how many tasks, and so files, the rows of one season are spread at most.
_SALTS = 16


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create the database unless it exists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _swapped_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another, by renames within their parent."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    new, place = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target))
    store = place.getFileSystem(conf)
    old = jvm.org.apache.hadoop.fs.Path(f"{staged}.replaced")
    if store.exists(place) and not store.rename(place, old):
        raise OSError(f"cannot set {target} aside")
    if not store.rename(new, place):
        raise OSError(f"cannot move {staged} to {target}; what it replaces is in {old}")
    store.delete(old, True)


def write_roster(
    df: DataFrame,
    target: str,
    mode: str = "replace",
    partition_by: Sequence[str] = (YEAR, GENDER),
    sort_by: Sequence[str] = SORT_COLUMNS,
    observation: Observation | None = None,
) -> None:
    """Write a Parquet roster, sorted by ``sort_by`` within files, in folders by ``partition_by``.

    ``target`` is a path (it holds a ``/``) or a table name; an existing table keeps its
    definition. ``replace`` swaps all rows, ``replace_seasons`` only the seasons in
    ``df`` (staged, then moved in), ``append`` adds.

    ``replace`` writes all rows first, to a folder beside a path or in scratch space for a
    table; while that can fail the old roster stands. Then a path is swapped by two renames
    (a crash between them leaves the old roster in a folder ``.staged-*.replaced`` beside the
    target, and the new one in ``.staged-*``), and a table takes the staged files over.

    Rows are spread by season and a hash within it: a season with a third of all rows is
    written by many tasks, and no folder gets more than ``_SALTS`` files. ``observation``
    receives the ingestion metrics from the same pass; it sits behind the last shuffle,
    where no finished task is run again.
    """
    if mode not in ("replace", "replace_seasons", "append"):
        raise ValueError(f"unknown mode '{mode}'")
    spark = df.sparkSession
    keys = [c for c in sort_by if c in df.columns]
    if keys:
        seasons = [c for c in partition_by if c in df.columns]
        salt = F.pmod(F.xxhash64(*keys), F.lit(_SALTS))
        df = df.repartition(*seasons, salt).sortWithinPartitions(*keys)
    if observation is not None:
        df = df.observe(observation, *ingestion_metrics(df, YEAR))

    if "/" in target:
        if mode == "replace":
            folder, _, name = target.rstrip("/").rpartition("/")
            staged = f"{folder}/.staged-{name}-{uuid.uuid4().hex}"
            df.write.partitionBy(*partition_by).parquet(staged)
            _swapped_in(spark, staged, target.rstrip("/"))
            return
        writer = df.write.mode("append" if mode == "append" else "overwrite")
        if mode == "replace_seasons":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).parquet(target)
    elif spark.catalog.tableExists(target):
        rows = df.select(*spark.table(target).columns)
        if mode != "append":
            rows = stored(rows, "staged-roster")
        how = "dynamic" if mode == "replace_seasons" else "static"
        rows.write.option("partitionOverwriteMode", how).insertInto(target, overwrite=mode != "append")
    else:
        df.write.partitionBy(*partition_by).format("parquet").saveAsTable(target)


def write_bucketed_roster(
    df: DataFrame, table: str, buckets: int, entity: str = ENTITY_KEY, sort_by: Sequence[str] = ()
) -> None:
    """A roster as a table in buckets of its entities; an existing one is replaced.

    Whatever goes entity by entity, such as ``unique_entity_histogram``, reads a bucket in a task
    and shuffles no row of it. Every bucket is one file, as rows are dealt like buckets before
    they are written; entities are many and a roster has few rows of each, while rows without
    one, of which there may be any number, are spread and make further files of one bucket.
    """
    spread = F.when(F.col(entity).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
    dealt = df.where(F.col(entity).isNotNull()).repartition(buckets, entity)
    lost = df.where(F.col(entity).isNull()).repartition(_SALTS, spread)
    writer = dealt.union(lost).write.mode("overwrite").bucketBy(buckets, entity)
    writer.sortBy(entity, *sort_by).format("parquet").saveAsTable(table)


def write_roster_chunks(
    frames: Iterable[DataFrame], target: str, mode: str = "replace", **options
) -> None:
    """Write several frames as one roster: all of them or, on an error while they are computed, none.

    Empty input is a ``ValueError`` and anything but a DataFrame a ``TypeError``, both
    before the target is touched.
    """
    chunks = list(frames)
    if not chunks:
        raise ValueError("no data frames to write")
    for chunk in chunks:
        if not isinstance(chunk, DataFrame):
            raise TypeError(f"expected Spark DataFrames, got {type(chunk).__name__}")
    write_roster(union_rosters(chunks), target, mode, **options)


def write_roster_jdbc(
    df: DataFrame,
    options: dict[str, str],
    table: str,
    mode: str = "replace",
    partitions: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Write rows to a database table; ``replace`` empties it and keeps its definition.

    ``partitions`` bounds the connections. The database commits per task: a job that is
    cut short leaves part of the rows, so run it again with ``replace``; and a task that is
    lost after its commit is repeated, so give the table a primary key, which turns
    doubled rows into a failed job.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode '{mode}'")
    writer = df.write.format("jdbc").options(
        **options, dbtable=table, numPartitions=str(partitions), batchsize=str(batch_size)
    )
    if mode == "replace":
        writer = writer.option("truncate", "true")
    writer.mode("overwrite" if mode == "replace" else "append").save()


def dump_comments(df: DataFrame, path: str) -> None:
    """All comments as JSON lines, as they came; an earlier dump is replaced."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
