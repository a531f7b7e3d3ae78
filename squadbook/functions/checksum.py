"""Content checksum and the aggregates of an ingestion record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a row is spelled before hashing.
_SEPARATOR = "\u0001"
_NULL = "\u0002"


def row_digest(columns: Sequence[str]) -> Column:
    """First 32 bits of the md5 of a row's cells."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in columns]
    digest = F.md5(F.concat_ws(_SEPARATOR, *cells))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("decimal(20,0)")


def content_checksum(columns: Sequence[str]) -> Column:
    """Sum of all row digests: the same for every row order and partitioning.

    A decimal sum, since 32-bit digests overflow a bigint after two billion rows.
    """
    return F.coalesce(F.sum(row_digest(columns)), F.lit(0)).cast("string")


def ingestion_metrics(df: DataFrame, year: str = "year") -> list[Column]:
    """Aggregates ``row_count, years, checksum``; the years of a roster are few."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.sort_array(F.collect_set(F.col(year).cast("int"))).alias("years"),
        content_checksum(df.columns).alias("checksum"),
    ]
