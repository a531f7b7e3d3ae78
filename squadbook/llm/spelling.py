"""Spelling variants: words one edit apart, hung on the far more frequent form.

1. Words and their numbers of occurrences are counted (``counted_words``).
2. Words of one length, and of that and the next, meet in blocks. A length's block is cut by
   the half that an edit leaves whole: two words one edit apart have the first half of the
   shorter one in common or the rest of it, so each word is in four blocks, whatever the number
   of words. A block beyond ``TILE`` words is cut once more into tiles, every two of which meet.
3. A block's words are vectors of letter counts. Their Gram matrix, a numpy product, gives the
   squared distances of all pairs at once; an edit changes them by one (a letter more) or two
   (a letter replaced), so pairs farther apart go, and the rest are compared letter by letter.
4. Each task adds its pairs up to one row a word and block: how many words are near, and the
   most frequent one. Roots are found by doubling the steps along forms.

Words are runs of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are lower-cased. Null and empty
texts have no words, repeated rows are counted each, a row without id has the empty text as
id, and an empty table gives an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadbook.llm.tasks import map_batches
from squadbook.runtime import discard, scratch_path, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# All letters are one byte in Latin-1, where bytes are in code-point order.
_LETTERS = np.concatenate((np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)))
# Words of a tile; words whose products are computed together; letters of the words of a tile.
TILE = 4096
PACK = 512
TILE_LETTERS = 1 << 24
# Rows of a Gram matrix, and letters of pairs, that are looked at together.
_ROWS = 1024
_PAIR_LETTERS = 1 << 22


def spoilt(doc_id: Column, run: Column, every: int) -> Column:
    """The run without one letter where ``every`` divides the hash of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def counted_words(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = 6,
    min_count: int = 5,
    spoil_every: int | None = None,
) -> DataFrame:
    """``word, n`` of the words of at least so many letters and occurrences.

    With ``spoil_every`` about one occurrence in so many loses a letter, the same on every run.
    """
    lowered = F.translate(F.col(text).cast("string"), _UPPER, _LOWER)
    # A maximal run that is too short cannot become a word.
    pattern = f"[a-zÀ-ÿ]{{{min_length},}}"
    runs = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))).alias("run"),
    )
    word = F.col("run") if spoil_every is None else spoilt(F.col("doc_id"), F.col("run"), spoil_every)
    words = runs.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _dealt(words: DataFrame, tile: int) -> DataFrame:
    """``unit, base, rest, word, n, side``: every word in its four blocks, or in tiles of them.

    ``base`` is the smaller length of the block, ``rest`` says which half its words share. In a
    tile of two parts ``side`` is 1 or 2, and only words of both are compared; else it is 0.
    """
    size = F.length("word")

    def blocks(base: Column) -> list[Column]:
        half = F.floor(base / 2).cast("int")
        first = F.substring(F.col("word"), F.lit(1), half)
        rest = F.substring(F.col("word"), size - base + half + 1, base - half)
        return [
            F.struct(
                base.alias("base"), F.lit(k).alias("rest"), F.xxhash64(base, F.lit(k), part).alias("unit")
            )
            for k, part in enumerate((first, rest))
        ]

    each = words.select("word", "n", F.explode(F.array(*blocks(size), *blocks(size - 1))).alias("b"))
    each = each.select("b.unit", "b.base", "b.rest", "word", "n")
    sizes = each.groupBy("unit").agg(
        F.count(F.lit(1)).alias("words"), F.sum(F.length("word")).alias("letters")
    )
    # Most blocks hold one word, which has nothing to be compared with there.
    parts = F.ceil(F.greatest(F.col("words") / tile, F.col("letters") / TILE_LETTERS)).cast("int")
    sizes = sizes.where(F.col("words") > 1).select("unit", parts.alias("parts"))
    met = each.join(stored(sizes, "spelling-blocks", "zstd"), "unit")
    columns = ["base", "rest", "word", "n"]
    whole = met.where("parts = 1").select("unit", *columns, F.lit(0).alias("side"))
    part, other = F.col("part"), F.col("other")
    cut = met.where("parts > 1").withColumn("part", F.pmod(F.xxhash64("word", F.lit(7)), "parts").cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(part == other, 0).when(part < other, 1).otherwise(2)
    tiles = cut.select(
        F.xxhash64("unit", F.least(part, other), F.greatest(part, other)).alias("unit"),
        *columns,
        side.alias("side"),
    )
    return whole.unionByName(tiles)


def packed(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Whole blocks, from batches sorted by ``unit``, together about ``limit`` rows or one block."""
    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        units = batch.column(batch.schema.get_field_index("unit")).to_numpy()
        fresh = np.concatenate(([last is None or units[0] != last], units[1:] != units[:-1]))
        last, at = units[-1], 0
        for start in np.flatnonzero(fresh).tolist():
            if rows + start - at >= limit:
                held.append(batch.slice(at, start - at))
                yield pa.Table.from_batches(held)
                held, rows, at = [], 0, start
        held.append(batch.slice(at))
        rows += batch.num_rows - at
    if held:
        yield pa.Table.from_batches(held)


def near_pairs(
    words: list[bytes], unit: np.ndarray, base: np.ndarray, rest: np.ndarray, side: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words that are one edit apart, each in one of the blocks it meets in.

    Rows are sorted by ``unit``. A pair that begins alike for half of ``base`` belongs to the
    block of that half, any other to the block of the rest.
    """
    sizes = np.array([len(w) for w in words])
    width = int(sizes.max()) + 1
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    kind = np.float32 if width < 2000 else np.float64  # exact for counts of that size
    flat = np.repeat(np.arange(len(words)), sizes) * 256 + np.frombuffer(b"".join(words), np.uint8)
    counts = np.bincount(flat, minlength=256 * len(words)).reshape(-1, 256)[:, _LETTERS].astype(kind)
    norms = (counts * counts).sum(1)
    shorter, longer = [], []
    for lo in range(0, len(words), _ROWS):
        hi = min(lo + _ROWS, len(words))
        # Rows of a block are neighbours; pairs of a row with an earlier one were found there.
        end = int(np.searchsorted(unit, unit[hi - 1], "right"))
        apart = norms[lo:hi, None] + norms[None, lo:end] - 2 * (counts[lo:hi] @ counts[lo:end].T)
        i, j = np.nonzero(apart <= 2)
        i, j = i + lo, j + lo
        fits = (i < j) & (unit[i] == unit[j]) & (base[i] == base[j]) & (rest[i] == rest[j])
        fits &= (np.minimum(sizes[i], sizes[j]) == base[i]) & (np.abs(sizes[j] - sizes[i]) <= 1)
        fits &= (side[i] == 0) | (side[i] != side[j])
        i, j = i[fits], j[fits]
        swap = sizes[i] > sizes[j]
        shorter.append(np.where(swap, j, i))
        longer.append(np.where(swap, i, j))
    i, j = np.concatenate(shorter), np.concatenate(longer)
    near = np.zeros(len(i), bool)
    step, place = max(1, _PAIR_LETTERS // width), np.arange(width)
    for lo in range(0, len(i), step):
        x, y = i[lo : lo + step], j[lo : lo + step]
        a, b = letters[x], letters[y]
        differ = a != b
        begin = differ.argmax(1)
        moved = np.zeros_like(b)
        moved[:, :-1] = b[:, 1:]
        goes_on = ((a != moved) & (place >= begin[:, None])).sum(1) == 0
        one_edit = np.where(sizes[y] > sizes[x], goes_on, differ.sum(1) == 1)
        near[lo : lo + step] = one_edit & ((begin < base[x] // 2) == (rest[x] == 1))
    return i[near], j[near]


def _near_words(words: DataFrame, tile: int) -> DataFrame:
    """``word, n_near, form_n, form`` of words with near ones: their number, the most frequent."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in packed(batches, PACK):
            coded = [w.encode("latin-1") for w in table.column("word").to_pylist()]
            unit, base, rest, side, n = (
                table.column(c).to_numpy() for c in ("unit", "base", "rest", "side", "n")
            )
            i, j = near_pairs(coded, unit, base, rest, side)
            if not len(i):
                continue
            of, to = np.concatenate((i, j)), np.concatenate((j, i))
            rank = np.empty(len(coded), np.int64)
            rank[sorted(range(len(coded)), key=coded.__getitem__)] = np.arange(len(coded))
            order = np.lexsort((rank[to], -n[to], of))
            of, to = of[order], to[order]
            found, first, near = np.unique(of, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("word").take(found).combine_chunks(),
                    pa.array(near, pa.int64()),
                    pa.array(n[to[first]], pa.int64()),
                    table.column("word").take(to[first]).combine_chunks(),
                ],
                ["word", "n_near", "form_n", "form"],
            )

    # Neighbours in a task are whole blocks, so a product serves many small ones.
    dealt = _dealt(words, tile).repartition("unit").sortWithinPartitions("unit")
    found = map_batches(dealt, compare, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"
    )


def followed(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` rows: the last of the forms, one after another.

    A form is several times as frequent as its word, so a chain has no circle and few links;
    every round doubles the steps that are taken, and ends in a written table.
    """
    spark = forms.sparkSession
    path = scratch_path(spark, "spelling-roots")
    forms.select("word", F.col("form").alias("root")).write.parquet(path)
    while True:
        roots = spark.read.schema("word string, root string").parquet(path)
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        after = scratch_path(spark, "spelling-roots")
        step.write.parquet(after)
        moved = roots.join(beyond, "root", "left_semi").limit(1).count()
        if not moved:
            discard(spark, [after])
            return roots
        discard(spark, [path])
        path = after


def spelling_variants(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = 6,
    min_count: int = 5,
    times: int = 5,
    spoil_every: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    Two words are near if one edit of a letter parts them. The near word with the largest
    ``n``, of several the first in code-point order, is the form of a word that it occurs at
    least ``times`` as often as; ``root`` is the form of the form and so on, or the word.
    """
    words = counted_words(
        docs, doc_id=doc_id, text=text, min_length=min_length, min_count=min_count, spoil_every=spoil_every
    )
    words = stored(words, "spelling-words", "zstd")
    near = words.join(_near_words(words, tile), "word", "left")
    is_form = F.col("form_n") >= F.col("n") * times
    near = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    near = stored(near, "spelling-near", "zstd")
    roots = followed(near.where(F.col("form").isNotNull()))
    root = F.coalesce("root", "word").alias("root")
    return near.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
