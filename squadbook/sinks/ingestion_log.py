"""Append-only record of roster loads."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ingestion_metrics
from ..sources.rosters import SeasonFile

# Payload columns of a log record, none of them NULL.
LOG_SCHEMA = "row_count bigint, years array<int>, source_files string, checksum string"
# Rows that were left out for want of a player id; NULL where nobody counted them.
REJECTED = "rejected"


def source_files(manifest: Iterable[SeasonFile]) -> str:
    """``{group: {year: path}}`` as JSON, groups and years in order."""
    files: dict[str, dict[str, str]] = {}
    for entry in sorted(manifest, key=lambda e: (e.group, e.year)):
        files.setdefault(entry.group, {})[str(entry.year)] = entry.path
    return json.dumps(files, ensure_ascii=False)


def append_log(
    spark: SparkSession,
    metrics: Mapping[str, object],
    manifest: Iterable[SeasonFile],
    log_path: str,
    rejected: int | None = None,
) -> None:
    """Append one record of metrics already at hand, such as those of an observed write."""
    row = (
        int(metrics["row_count"]),
        [int(year) for year in metrics["years"]],
        source_files(manifest),
        str(metrics["checksum"]),
        rejected,
    )
    record = spark.createDataFrame([row], f"{LOG_SCHEMA}, {REJECTED} bigint")
    _append(record, log_path)


def log_ingestion(
    df: DataFrame, manifest: Iterable[SeasonFile], log_path: str, year: str = "year"
) -> None:
    """Measure a roster in one pass and append the record."""
    record = df.agg(*ingestion_metrics(df, year)).select(
        "row_count", "years", F.lit(source_files(manifest)).alias("source_files"), "checksum"
    ).withColumn(REJECTED, F.lit(None).cast("bigint"))
    _append(record, log_path)


def _append(record: DataFrame, log_path: str) -> None:
    stamped = record.select(F.current_timestamp().alias("ingested_at"), "*")
    stamped.coalesce(1).write.mode("append").parquet(log_path)
