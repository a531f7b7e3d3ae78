"""Landed search and comment pages to video ids and comments.

Pages are rows with a JSON text column ``page``, as a landing job stores the responses
of a comment service: search pages with ``term_no`` and ``page_no``, comment pages with
``video_id``, ``video_ord`` (the place of the video in the walk) and ``page_no``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedup import dedup_first
from ..schema import (
    COMMENT_PAGE_SCHEMA,
    COMMENT_SCHEMA,
    SEARCH_PAGE_SCHEMA,
)

_CORRUPT = "_corrupt_record"


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """Comments from JSON lines."""
    return spark.read.schema(COMMENT_SCHEMA).json(path)


def _parse(page: Column, schema: str) -> Column:
    return F.from_json(
        page,
        f"{schema}, {_CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )


def parse_pages(
    pages: DataFrame, schema: str, page: str = "page", parsed: str = "parsed"
) -> DataFrame:
    """The pages with the struct ``parsed`` and whether they are ``broken``, in one frame.

    One broken page never stops the others. A page that is missing counts as broken. The
    one-row explode keeps the optimizer from parsing a page again for every filter on it.
    """
    read = pages.withColumn(parsed, F.explode(F.array(_parse(F.col(page), schema))))
    broken = F.col(parsed).isNull() | F.col(f"{parsed}.{_CORRUPT}").isNotNull()
    return read.withColumn("broken", broken).withColumn(parsed, F.col(parsed).dropFields(_CORRUPT))


def split_corrupt(
    pages: DataFrame, schema: str, page: str = "page", parsed: str = "parsed"
) -> tuple[DataFrame, DataFrame]:
    """Pages that parse, with the struct ``parsed``, and the broken ones to set aside.

    Reading both frames parses twice; ``parse_pages`` gives one frame with a flag.
    """
    read = parse_pages(pages, schema, page, parsed)
    return read.where(~F.col("broken")).drop("broken"), read.where("broken").drop(parsed, "broken")


def video_places(search_pages: DataFrame) -> DataFrame:
    """``video_id, term_no, page_no, pos`` of every result, also without an id; pages may stream."""
    good, _ = split_corrupt(search_pages, SEARCH_PAGE_SCHEMA)
    items = good.select("term_no", "page_no", F.posexplode("parsed.items").alias("pos", "item"))
    return items.select(F.col("item.id.videoId").alias("video_id"), "term_no", "page_no", "pos")


def extract_video_ids(search_pages: DataFrame, per_term: int | None = None) -> DataFrame:
    """``video_id, term_no, page_no, pos``: each video at its first place in the walk.

    All results that were landed count, or with ``per_term`` the first ones of every term.
    Results without an id are skipped.
    """
    items = video_places(search_pages)
    if per_term is not None:
        in_term = Window.partitionBy("term_no").orderBy("page_no", "pos")
        items = (
            items.withColumn("__nth", F.row_number().over(in_term))
            .where(F.col("__nth") <= per_term)
            .drop("__nth")
        )
    return dedup_first(
        items.where(F.col("video_id") != ""), ["video_id"], ["term_no", "page_no", "pos"]
    )


def extract_comments(comment_pages: DataFrame) -> DataFrame:
    """Comments with their place ``video_ord, page_no, pos``; absent fields get defaults.

    A page is unfolded on its own, so pages may be a stream.
    """
    good, _ = split_corrupt(comment_pages, COMMENT_PAGE_SCHEMA)
    items = good.select(
        "video_id", "video_ord", "page_no", F.posexplode("parsed.items").alias("pos", "item")
    )
    snippet = F.col("item.snippet.topLevelComment.snippet")
    return items.select(
        "video_id",
        F.coalesce(F.col("item.id"), F.lit("")).alias("comment_id"),
        F.coalesce(snippet["authorDisplayName"], F.lit("unknown")).alias("author"),
        F.coalesce(snippet["textDisplay"], F.lit("")).alias("text"),
        "video_ord",
        "page_no",
        "pos",
    )
