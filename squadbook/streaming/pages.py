"""A stream of landed pages, with the broken ones set aside.

A micro-batch is parsed once and written once: its folder has one part for pages that parse
and one for broken ones, so both come out of the same job and are replaced together when the
batch runs again. One broken page never stops the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sinks.batches import read_batches, write_batch
from ..sources.comments import parse_pages
from .comments import AVAILABLE_NOW

BROKEN = "broken"


def stream_split_corrupt(
    pages: DataFrame,
    page_schema: str,
    path: str,
    checkpoint: str,
    page: str = "page",
    parsed: str = "parsed",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Parse pages as they come; ``read_good_pages`` and ``read_broken_pages`` tell them apart.

    The text of a page is kept only where it is broken, its struct only where it is not.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        read = parse_pages(batch, page_schema, page, parsed)
        kept = read.withColumns(
            {
                page: F.when(F.col(BROKEN), F.col(page)),
                parsed: F.when(~F.col(BROKEN), F.col(parsed)),
            }
        )
        write_batch(kept, path, batch_id, partition_by=(BROKEN,))

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def _written_schema(
    spark: SparkSession, pages: StructType, page_schema: str, page: str, parsed: str
) -> StructType:
    """Of what ``stream_split_corrupt`` writes."""
    empty = parse_pages(spark.createDataFrame([], pages), page_schema, page, parsed)
    return empty.schema


def _read(spark, path, pages, page_schema, page, parsed, broken: bool) -> DataFrame:
    schema = pages if isinstance(pages, StructType) else StructType.fromDDL(pages)
    written = _written_schema(spark, schema, page_schema, page, parsed)
    rows = read_batches(spark, path, written)
    return rows.where(F.col(BROKEN) == broken).drop(BROKEN)


def read_good_pages(
    spark: SparkSession,
    path: str,
    pages: str | StructType,
    page_schema: str,
    page: str = "page",
    parsed: str = "parsed",
) -> DataFrame:
    """Pages that parsed, with the struct ``parsed`` and their ``batch_id``; no broken part is read."""
    return _read(spark, path, pages, page_schema, page, parsed, False).drop(page)


def read_broken_pages(
    spark: SparkSession,
    path: str,
    pages: str | StructType,
    page_schema: str,
    page: str = "page",
    parsed: str = "parsed",
) -> DataFrame:
    """The broken pages as they came, with their ``batch_id``."""
    return _read(spark, path, pages, page_schema, page, parsed, True).drop(parsed)


