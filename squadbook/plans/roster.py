"""From season files to the unified roster table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import composite_id, tolerant_integer
from ..operators.align import (
    conform,
    ensure_entity_key,
    fallback_column,
    merge_aliases,
    normalize_columns,
    order_columns,
    tag_source,
    union_rosters,
)
from ..operators.dedup import dedup_first, split_missing_key
from ..schema import (
    ENTITY_KEY,
    EXPECTED_SEASONS,
    GENDER,
    NAME_FALLBACKS,
    PLAYER_ID,
    REQUIRED_COLUMNS,
    SORT_COLUMNS,
    TYPE_MAP,
    YEAR,
)
from ..sinks.ingestion_log import append_log
from ..sinks.tables import write_roster
from ..sources.rosters import GROUP, SEASON, SeasonFile, read_manifest

# Cast as they stand: in "Jun 30, 2021" the first number is no contract year.
_PLAIN_INTEGERS = ("contract_valid_until", "age")


def _complete(df: DataFrame) -> DataFrame:
    """Synonyms, key, names and player id for rows that carry their season and group."""
    df = ensure_entity_key(merge_aliases(df))
    for target, source in NAME_FALLBACKS.items():
        df = fallback_column(df, target, source)
    plain = {
        name: tolerant_integer(F.col(name), "int", df.schema[name].dataType)
        if name in df.columns
        else F.lit(None).cast("int")
        for name in _PLAIN_INTEGERS
    }
    player_id = composite_id(F.col(GENDER), F.col(YEAR), F.col(ENTITY_KEY))
    return df.withColumns({**plain, PLAYER_ID: player_id})


def standardize_roster(df: DataFrame, year: int, group: str) -> DataFrame:
    """One season with canonical columns, its tags and one row per player id."""
    return dedup_first(_complete(tag_source(normalize_columns(df), year, group)), [PLAYER_ID])


def _tagged(raw: DataFrame) -> DataFrame:
    """Raw rows of several seasons under canonical names, with their season and group."""
    named = normalize_columns(raw, keep=(GROUP, SEASON))
    tags = {YEAR: F.col(SEASON), GENDER: F.lower(GROUP)}
    return named.withColumns(tags).drop(GROUP, SEASON)


def build_roster(
    spark: SparkSession,
    manifest: Iterable[SeasonFile],
    expected: Mapping[str, Sequence[int]] = EXPECTED_SEASONS,
    order: Sequence[str | Column] = (),
    infer: bool = False,
    sort: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The unified roster, and the rows without a player id that it leaves out.

    The player id holds group and season, so one selection over the union does the work
    of one per file: of several rows with one id the first by ``order`` stays, then by
    the other columns. The plan has one scan and one alignment for each distinct header. ``sort=False`` leaves the global sort to the sink.
    """
    frames = read_manifest(spark, manifest, expected, infer)
    aligned = union_rosters(_complete(_tagged(frame)) for frame in frames)
    unified = order_columns(conform(aligned, REQUIRED_COLUMNS, TYPE_MAP))
    keyed, rejected = split_missing_key(unified, PLAYER_ID)
    roster = dedup_first(keyed, [PLAYER_ID], order)
    return (sort_roster(roster) if sort else roster), rejected


def sort_roster(df: DataFrame) -> DataFrame:
    """Global order by season, group, player id, club and name; NULLs first."""
    return df.orderBy(*SORT_COLUMNS)


def load_roster(
    spark: SparkSession,
    manifest: Sequence[SeasonFile],
    target: str,
    log_path: str,
    expected: Mapping[str, Sequence[int]] = EXPECTED_SEASONS,
) -> int:
    """Build, write and log a roster; returns its row count.

    The roster is built and written in one pass over the files. Rows without a player id are
    counted in a second one, that parses only what an id is made of, and logged as well.
    """
    roster, rejected = build_roster(spark, manifest, expected, sort=False)
    observation = Observation()
    write_roster(roster, target, observation=observation)
    metrics = observation.get
    append_log(spark, metrics, manifest, log_path, rejected.count())
    return metrics["row_count"]
