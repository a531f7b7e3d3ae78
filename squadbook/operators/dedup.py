"""Deterministic one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position"


def dedup_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """The first row of each key by ``order``, ties broken by all other columns.

    Column names in ``order`` sort ascending with NULLs last. Rows equal in every
    column are interchangeable, so the result does not depend on row order or
    partitioning. The ``= 1`` cut on ``row_number`` runs before the shuffle as well:
    a task sends one row per key, however many rows a hot key has.
    """
    ordering = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    ordering += [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    if not ordering:
        return df.dropDuplicates(list(keys))
    by_key = Window.partitionBy(*keys).orderBy(*ordering)
    return (
        df.withColumn(_POSITION, F.row_number().over(by_key))
        .where(F.col(_POSITION) == 1)
        .drop(_POSITION)
    )


def split_missing_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and rows without one (kept whole, never collapsed to one)."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
