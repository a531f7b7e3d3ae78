"""The reports on the unified roster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.mentions import (
    EmptyResultError,
    build_alias_dim,
    count_mentions,
    mention_summary,
    prepare_aliases,
)
from ..operators.ranking import (
    mode_per_partition,
    rank_groups_by_avg,
    roster_cohort,
    top_groups_by_count,
    unique_entity_histogram,
)
from ..runtime import stored
from ..schema import ENTITY_KEY, GENDER, PLAYER_ID, YEAR


def expiring_contracts(roster: DataFrame, year: int, top: int, contract_year: int) -> DataFrame:
    """Clubs with the most players of a season under contract until at least a year."""
    under_contract = (F.col(YEAR) == year) & (F.col("contract_valid_until") >= contract_year)
    return top_groups_by_count(roster, "club_name", top, where=under_contract)


def average_age_ranking(roster: DataFrame, year: int, top: int, order: str = "desc") -> DataFrame:
    """Clubs of a season by the average age of their players."""
    return rank_groups_by_avg(roster, "club_name", "age", top, order, F.col(YEAR) == year)


def popular_nationality(roster: DataFrame) -> DataFrame:
    """The most frequent nationality of every season."""
    return mode_per_partition(roster, YEAR, "nationality_name")


def nationality_histogram(roster: DataFrame) -> DataFrame:
    """Players per nationality, each player counted once, at their latest season."""
    latest = [F.desc(YEAR), F.asc(GENDER), F.asc(PLAYER_ID)]
    return unique_entity_histogram(roster, ENTITY_KEY, "nationality_name", latest)


def most_discussed_player(
    roster: DataFrame,
    comments: DataFrame,
    year: int = 2022,
    group: str = "male",
    key: Sequence[str] | None = None,
    boundary: str = "word",
) -> DataFrame:
    """Mentions of a season's players in comments, beside the most mentioned of them.

    Every row of ``comments`` is a comment, unless ``key`` names what tells them apart.
    """
    aliases = prepare_aliases(build_alias_dim(roster_cohort(roster, year, group)), boundary)
    if not aliases.shapes:
        raise EmptyResultError(f"no players in the {group} roster of {year}")
    counts = stored(count_mentions(comments, aliases, key), "mentions")
    summary = mention_summary(counts)
    if counts.isEmpty():
        raise EmptyResultError("no mentions found")
    return summary
