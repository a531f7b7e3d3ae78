"""Quality rules over documents, with the frequency of lines across the documents of a host.

Built-in functions only. A row is a document, also where ids repeat or are null. A null
text is empty; null and empty hosts are one host; an empty table gives an empty result;
other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadbook.runtime import stored

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def covered_by_repeats(hashes: Column, width: int) -> Column:
    """How many positions lie in windows of ``width`` whose hash occurs twice or more.

    ``hashes`` holds one hash per window start. Only rows with a repeat sort anything.
    """
    ordered = F.array_sort(
        F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    )

    def repeated(a: Column) -> Column:
        def position(s: Column, i: Column) -> Column:
            before, after = F.get(a, i - 1)["h"], F.get(a, i + 1)["h"]
            return F.when(before.eqNullSafe(s["h"]) | after.eqNullSafe(s["h"]), s["p"])

        return F.array_sort(F.array_compact(F.transform(a, position)))

    def covered(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    # A lambda's argument is computed once; a column named twice within one may not be.
    positions = F.transform(F.array(ordered), repeated)
    total = F.get(F.transform(positions, covered), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(F.lit(0))


def line_key(line: Column) -> Column:
    """Lines that differ in case, punctuation or spacing alone have one key."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " "))))


def text_measures(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    has_word = r"[^\x20\x09-\x0D]"
    cut = rows.withColumns(
        {
            "words": split_words(F.col("text")),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(has_word)),
        }
    )
    windows = F.expr(
        f"transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW})))"
    )
    hashed = cut.select(
        "row",
        "doc_id",
        "host",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("words") >= WINDOW, windows)
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
        F.transform(
            "lines",
            lambda x: F.struct(line_key(x).alias("h"), F.size(split_words(x)).alias("w")),
        ).alias("lines"),
    )
    return hashed.select(
        "row",
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        covered_by_repeats(F.col("windows"), WINDOW).cast("bigint").alias("n_repeat_words"),
        "lines",
    )


def quality_rules(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    min_documents: int = 20,
    max_line_percent: int = 5,
    max_line_documents: int = 1000,
    min_left_percent: int = 50,
) -> DataFrame:
    """Measures and verdict of every document.

    A line is removed from the documents of a host if ``max_line_documents`` of them hold it,
    however large the host, or ``max_line_percent`` in a hundred and at least ``min_documents``
    (compared without case, punctuation and spacing). A document fails if it has fewer than ``min_words`` words, if more than
    ``max_repeat_percent`` of its words lie in repeated windows, or if fewer than
    ``min_left_percent`` of its words are left once such lines are gone.

    The measures are stored once and read by the two counts; texts are not shuffled. Lines
    are counted with map-side parts, so a line that every document holds costs a row a task.
    """
    measures = stored(text_measures(docs, doc_id, text, host), "quality")
    counted = (
        measures.select("host", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
        .groupBy("host", "h")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min(min_documents, max_line_documents))
    )
    hosts = measures.groupBy("host").agg(F.count(F.lit(1)).alias("all_documents"))
    frequent = (
        counted.join(hosts, "host")
        .where(
            (F.col("documents") >= max_line_documents)
            | (F.col("documents") * 100 >= F.col("all_documents") * max_line_percent)
        )
        .select("host", "h")
    )
    removed = (
        measures.select("row", "host", F.explode("lines").alias("line"))
        .select("row", "host", "line.h", "line.w")
        .join(frequent, ["host", "h"])
        .groupBy("row")
        .agg(
            F.sum("w").cast("bigint").alias("n_removed_words"),
            F.count(F.lit(1)).alias("n_removed_lines"),
        )
    )
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent
    )
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        measures.drop("lines")
        .join(removed, "row", "left")
        .fillna(0, ["n_removed_words", "n_removed_lines"])
        .withColumn("base_failed", failed)
        .withColumn(
            "kept",
            ~F.col("base_failed") & (left * 100 >= F.col("n_words") * min_left_percent),
        )
        .drop("row", "host")
    )
