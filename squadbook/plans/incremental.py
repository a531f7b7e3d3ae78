"""A load that reads only the seasons that changed.

Every load writes, beside the ingestion log, what it loaded: season by season the digest of the
files (``season_digests``). The next load lists the files, leaves out the seasons whose digest
is the last one logged, and replaces the partitions of the others. Rows of one player id are of
one season, so a season can be built without the others; groups with one initial share their
ids, so such seasons are loaded together.

Partitions are written before the log. A load that is cut short between the two is done again
by the next one, for the seasons that the log lacks; replacing a partition twice does no harm.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import EXPECTED_SEASONS, GENDER, YEAR
from ..sinks.ingestion_log import append_log
from ..sinks.tables import write_roster
from ..sources.rosters import ManifestError, SeasonFile, season_digests
from .roster import build_roster

SEASON_LOG = "group string, year int, digest string, load bigint"


@dataclass(frozen=True)
class Load:
    """What an incremental load did: seasons as ``(group, year)``, and the rows it wrote."""

    loaded: tuple[tuple[str, int], ...]
    removed: tuple[tuple[str, int], ...]
    row_count: int


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def logged_seasons(spark: SparkSession, season_log: str) -> DataFrame:
    """``group, year, digest, load``: of every season what was logged last; no digest if removed."""
    store, folder = _store(spark, season_log)
    if not store.exists(folder):
        return spark.createDataFrame([], SEASON_LOG)
    last = Window.partitionBy("group", "year").orderBy(F.desc("load"))
    rows = spark.read.schema(SEASON_LOG).parquet(season_log)
    return rows.withColumn("last", F.row_number().over(last)).where("last = 1").drop("last")


def changed_seasons(
    spark: SparkSession, digests: Mapping[SeasonFile, str], season_log: str
) -> tuple[list[SeasonFile], list[tuple[str, int]], int]:
    """Entries to load, logged seasons the manifest lacks, and the number of the next load."""
    rows = [(e.group, e.year, digest) for e, digest in digests.items()]
    listed = spark.createDataFrame(rows, "group string, year int, digest string")
    logged = logged_seasons(spark, season_log)
    known = logged.where(F.col("digest").isNotNull())
    fresh = listed.join(known, ["group", "year", "digest"], "left_anti").select("group", "year").collect()
    gone = known.join(listed, ["group", "year"], "left_anti").select("group", "year").collect()
    # Groups of one initial have player ids in common.
    stale = {(r["group"][:1].lower(), r["year"]) for r in [*fresh, *gone]}
    entries = [e for e in digests if (e.group[:1].lower(), e.year) in stale]
    number = (logged.agg(F.max("load")).first()[0] or 0) + 1
    return entries, [(r["group"], r["year"]) for r in gone], number


def load_changed_seasons(
    spark: SparkSession,
    manifest: Sequence[SeasonFile],
    target: str,
    log_path: str,
    season_log: str,
    expected: Mapping[str, Sequence[int]] = EXPECTED_SEASONS,
) -> Load:
    """Bring the roster at the path ``target`` up to the manifest; log what was loaded.

    The result is what a whole load would write. Seasons that the manifest no longer has, and
    seasons whose files have no rows any more, lose their partition. Read it with
    ``read_roster``: partitions that were written at different times may differ in columns.
    """
    by_season = {(e.group, e.year): e for e in manifest}
    gaps = [(g, y) for g, years in expected.items() for y in years if (g, y) not in by_season]
    if gaps:
        raise ManifestError(f"manifest has no entry for {gaps}")
    digests = season_digests(spark, by_season.values())
    entries, gone, number = changed_seasons(spark, digests, season_log)
    seasons = [(e.group, e.year) for e in entries]
    rows, without = 0, set(gone)
    if entries:
        roster, rejected = build_roster(spark, entries, {}, sort=False)
        written, observation = Observation(), Observation()
        there = F.collect_set(F.struct(GENDER, YEAR)).alias("seasons")
        write_roster(roster.observe(written, there), target, mode="replace_seasons", observation=observation)
        rows = observation.get["row_count"]
        filled = {(r[GENDER], r[YEAR]) for r in written.get["seasons"]}
        without |= {(g, y) for g, y in seasons if (g.lower(), y) not in filled}
        append_log(spark, observation.get, entries, log_path, rejected.count())
    for group, year in without:
        store, folder = _store(spark, f"{target}/{YEAR}={year}/{GENDER}={group.lower()}")
        store.delete(folder, True)
    logged = [(e.group, e.year, digests[e], number) for e in entries]
    logged += [(group, year, None, number) for group, year in gone]
    if logged:
        spark.createDataFrame(logged, SEASON_LOG).coalesce(1).write.mode("append").parquet(season_log)
    return Load(tuple(sorted(seasons)), tuple(sorted(gone)), rows)


def read_roster(spark: SparkSession, target: str) -> DataFrame:
    """A roster whose partitions may differ in columns; what a partition lacks is null."""
    return spark.read.option("mergeSchema", True).parquet(target)
