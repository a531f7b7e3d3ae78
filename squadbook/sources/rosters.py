"""Season files and the manifest that names them."""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import EXPECTED_SEASONS

EXPECTED_SCHEMA = "group string, year int"
MANIFEST_SCHEMA = "group string, year int, path string"

# Columns that name the season a raw row comes from.
GROUP, SEASON = "__group", "__season"

_FILE = "__file"
_HEADER_READS = 8


class ManifestError(ValueError):
    """The manifest lacks a season or is malformed."""


@dataclass(frozen=True)
class SeasonFile:
    """One season of one group: a CSV file, or a folder or pattern of CSV files."""

    group: str
    year: int
    path: str


def read_roster_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """A CSV with header. Cells stay strings unless ``infer`` asks for a pass to type them."""
    return spark.read.csv(path, header=True, inferSchema=infer)


def parse_manifest(base: str, mapping: Mapping[str, Mapping[int, str]]) -> list[SeasonFile]:
    """``{group: {year: file name}}`` below the folder ``base`` as manifest entries."""
    entries = []
    for group, seasons in mapping.items():
        if not isinstance(seasons, Mapping):
            raise ManifestError(f"'{group}' must map years to file names")
        for year, name in seasons.items():
            entries.append(SeasonFile(group, int(year), f"{base.rstrip('/')}/{name}"))
    return entries


def manifest_frame(spark: SparkSession, entries: Iterable[SeasonFile]) -> DataFrame:
    return spark.createDataFrame([astuple(e) for e in entries], MANIFEST_SCHEMA)


def expected_frame(
    spark: SparkSession, expected: Mapping[str, Sequence[int]] = EXPECTED_SEASONS
) -> DataFrame:
    rows = [(group, year) for group, years in expected.items() for year in years]
    return spark.createDataFrame(rows, EXPECTED_SCHEMA)


def check_manifest(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Expected ``(group, year)`` rows the manifest table has no entry for."""
    season = ["group", "year"]
    return expected.join(manifest.select(season).distinct(), season, "left_anti")


def _listed(spark: SparkSession, entry: SeasonFile) -> list:
    """The status of every CSV file of an entry."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(entry.path)
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in store.globStatus(pattern) or ():
        inside = store.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [s for s in inside if s.isFile() and s.getPath().getName()[0] not in "_."]
    if not found:
        raise FileNotFoundError(entry.path)
    return found


def season_digests(spark: SparkSession, manifest: Iterable[SeasonFile]) -> dict[SeasonFile, str]:
    """For every entry a digest of its files' names, lengths and times of writing.

    Files are listed and not read, so one that is written again with the same length within
    the same tick of its store's clock looks unchanged.
    """

    def digest(entry: SeasonFile) -> str:
        files = sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in _listed(spark, entry))
        return hashlib.md5(repr(files).encode()).hexdigest()

    entries = list(manifest)
    with ThreadPoolExecutor(_HEADER_READS) as pool:
        return dict(zip(entries, pool.map(digest, entries)))


def _headers(spark: SparkSession, entry: SeasonFile) -> list[tuple[str, tuple[str, ...]]]:
    """The CSV files of an entry, each with its header; only first lines are read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = [s.getPath() for s in _listed(spark, entry)]
    store = found[0].getFileSystem(conf)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    files = []
    for path in found:
        stream = store.open(path)
        try:
            codec = codecs.getCodec(path)
            plain = codec.createInputStream(stream) if codec is not None else stream
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
            line = reader.readLine()
        finally:
            stream.close()
        if line is not None:
            cells = next(csv.reader([line.removeprefix("\ufeff")]), [])
            header = tuple(cell or f"_c{i}" for i, cell in enumerate(cells))
            files.append((path.toUri().toString(), header))
    return files


def read_manifest(
    spark: SparkSession,
    manifest: Iterable[SeasonFile],
    expected: Mapping[str, Sequence[int]] = EXPECTED_SEASONS,
    infer: bool = False,
) -> list[DataFrame]:
    """The raw rows of all seasons, one frame per distinct header, with ``GROUP`` and ``SEASON``.

    All seasons of the manifest are read, also those beyond the expected. A missing season
    raises ``ManifestError`` before any file is touched, a missing file ``FileNotFoundError``.
    First lines are looked up several files at a time; files with one header are one scan,
    however many there are, and a row's season comes from the file it is in. Columns go by
    name, so files of one folder may differ in their order; cells stay strings unless
    ``infer`` asks for a pass to type them.
    """
    by_season = {(e.group, e.year): e for e in manifest}
    wanted = [(group, year) for group, years in expected.items() for year in years]
    gaps = [season for season in wanted if season not in by_season]
    if gaps:
        raise ManifestError(f"manifest has no entry for {gaps}")
    entries = list(by_season.values())
    with ThreadPoolExecutor(_HEADER_READS) as pool:
        listed = list(pool.map(lambda e: _headers(spark, e), entries))
    by_header: dict[tuple[str, ...], list[tuple[str, str, int]]] = {}
    for entry, files in zip(entries, listed):
        for path, header in files:
            by_header.setdefault(header, []).append((path, entry.group, entry.year))
    return [_read_files(spark, header, files, infer) for header, files in by_header.items()]


def _read_files(
    spark: SparkSession, header: tuple[str, ...], files: list[tuple[str, str, int]], infer: bool
) -> DataFrame:
    paths = [path for path, _, _ in files]
    if infer:
        rows = spark.read.csv(paths, header=True, inferSchema=True, enforceSchema=False)
    else:
        text = StructType([StructField(name, StringType()) for name in header])
        rows = spark.read.schema(text).csv(paths, header=True, enforceSchema=False)
    rows = rows.select("*", _plain_path(F.col("_metadata.file_path")).alias(_FILE))
    seasons = spark.createDataFrame(files, f"{_FILE} string, {GROUP} string, {SEASON} int")
    seasons = seasons.withColumn(_FILE, _plain_path(F.col(_FILE)))
    # One row for each file of the manifest, which the driver has listed.
    return rows.join(F.broadcast(seasons), _FILE).drop(_FILE)


def _plain_path(path: Column) -> Column:
    """Paths of one file may differ in how many slashes follow their scheme."""
    return F.regexp_replace(path, "^([a-z0-9+.-]+:)/+", "$1/")
