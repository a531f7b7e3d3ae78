"""Removal of byte strings of a given length that occur more than once in a collection.

Suffixes are sorted (``suffixes.two_stage``) where repeats can be, in tasks of bounded size:

1. Every string of ``length`` bytes has an anchor, the run of ``GRAM`` bytes in it with the
   least hash (the first of equals). Strings in a row with one anchor are a piece of text.
   Equal strings have equal anchors at equal places, so a string whose anchor occurs nowhere
   else is unique, and all others meet in the group of their anchor.
2. Pieces with the same bytes are counted and one of them stands for all. A group with one
   distinct piece is settled by the count.
3. The distinct pieces of a group go to one task, where their suffix array and the common
   prefixes of neighbours show which strings occur in several pieces.
4. A group that is too large for a task (a short passage in very many documents) is cut into
   pieces of fewer strings, which meet again by the bytes that all of them have in common,
   in the limit the strings themselves.

Documents are named by id and a hash of the text, so texts need not be numbered or stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadbook.llm.arrays import mix, powers, prefix_hashes, span_hashes, text_bytes
from squadbook.llm.suffixes import repeated_starts
from squadbook.llm.tasks import map_batches, slices, sorted_groups
from squadbook.runtime import stored

GRAM = 100
# Places hashed at a time, so that arrays stay in a processor's cache; below 2^24.
BLOCK = 1 << 17
TEXT_BYTES = 1 << 20
# Bytes of pieces that are sorted together, and of a group that is sorted in one go.
SORT_BYTES = 1 << 18


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    size, best = 1, values
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size :])
    return best


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[dict[str, np.ndarray]]:
    """Pieces of texts: ``row, start, n`` strings, place of the anchor, and two hashes."""
    _, inverse = powers(BLOCK + length)
    for lo in range(0, len(data) - length + 1, BLOCK):
        hi = min(lo + BLOCK, len(data) - length + 1)
        sums = prefix_hashes(data[lo : hi + length - 1])
        grams = (sums[GRAM:] - sums[:-GRAM]) * inverse[: len(sums) - GRAM]
        grams *= np.uint64(0xD6E8FEB86659FD93)
        # The place in the low bits makes the first of equal hashes the least.
        ranked = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
        best = least_in_windows(ranked, length - GRAM + 1)
        anchor = (best & np.uint64((1 << 24) - 1)).astype(np.int64)
        # Strings that run into the next text are none.
        near = np.arange(np.searchsorted(offsets, lo, "right"), np.searchsorted(offsets, hi + length - 1, "left"))
        valid = np.ones(hi - lo, bool)
        for border in offsets[near].tolist():
            valid[max(0, border - length + 1 - lo) : max(0, border - lo)] = False
        begins = valid.copy()
        begins[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        stop = valid.copy()
        stop[:-1] &= begins[1:] | ~valid[1:]
        ends = np.flatnonzero(stop) + 1
        row = np.searchsorted(offsets, starts + lo, "right") - 1
        yield {
            "row": row,
            "start": starts + lo - offsets[row],
            "n": ends - starts,
            "place": anchor[starts] - starts,
            "h": mix(grams[anchor[starts]]).view(np.int64),
            "x": span_hashes(sums, starts, ends + length - 1).view(np.int64),
        }


NAME = ["doc_id", "name"]


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("name"), body.cast("binary").alias("bytes")
    )


def _pieces(named: DataFrame, length: int) -> DataFrame:
    kind = named.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", TEXT_BYTES):
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            for found in pieces_of(*text_bytes(column("bytes")), length):
                rows = pa.array(found["row"])
                yield pa.RecordBatch.from_arrays(
                    [column("doc_id").take(rows), column("name").take(rows)]
                    + [pa.array(found["start"])]
                    + [pa.array(found[c], pa.int32()) for c in ("n", "place")]
                    + [pa.array(found["h"]), pa.array(found["x"])],
                    [*NAME, "start", "n", "place", "h", "x"],
                )

    schema = f"doc_id {kind}, name bigint, start bigint, n int, place int, h bigint, x bigint"
    return map_batches(named, cut, schema)


def _grouped(classes: DataFrame, length: int) -> DataFrame:
    """Classes of pieces (``h, x, copies, n``) whose group holds a repeat, with its measures."""
    groups = classes.groupBy("h").agg(
        F.sum("copies").alias("all_copies"),
        F.count(F.lit(1)).alias("distinct"),
        F.sum(F.col("n") + F.lit(length - 1)).alias("group_bytes"),
    )
    return classes.join(groups.where(F.col("all_copies") > 1).drop("all_copies"), "h")


def _sorted(pieces: DataFrame, length: int) -> DataFrame:
    """``h, x, spans``: repeated starts of pieces (``h, x, copies, n, bytes``), by suffix arrays.

    Whole groups are sorted together until a task has held enough bytes for one array.
    """
    dealt = pieces.select("h", "x", "copies", "n", "bytes").repartition("h").sortWithinPartitions("h")

    def settle(tables: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(tables)
        repeats = repeated_starts(table["bytes"].to_pylist(), length)
        spans = []
        for found, copies, n in zip(repeats, table["copies"].to_pylist(), table["n"].to_pylist()):
            if copies > 1:
                spans.append([(0, n)])
                continue
            cuts = np.flatnonzero(np.diff(found) != 1)
            firsts = np.concatenate((found[:1], found[cuts + 1])) if len(found) else found
            lasts = np.concatenate((found[cuts], found[-1:])) if len(found) else found
            spans.append([(int(a), int(b) + 1) for a, b in zip(firsts, lasts)])
        return _span_batch(table["h"].to_pylist(), table["x"].to_pylist(), spans)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for _, table in sorted_groups(batches, "h"):
            held.append(table)
            size += table["bytes"].nbytes
            if size >= SORT_BYTES:
                yield settle(held)
                held, size = [], 0
        if held:
            yield settle(held)

    return map_batches(dealt, sort, _SPANS).where(F.size("spans") > 0)


_SPANS = "h bigint, x bigint, spans array<struct<lo:int,hi:int>>"
_SPAN = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])


def _span_batch(h: list, x: list, spans: list) -> pa.RecordBatch:
    rows = [[{"lo": a, "hi": b} for a, b in s] for s in spans]
    return pa.RecordBatch.from_arrays(
        [pa.array(h, pa.int64()), pa.array(x, pa.int64()), pa.array(rows, pa.list_(_SPAN))],
        ["h", "x", "spans"],
    )


def _cut_finer(pieces: DataFrame, length: int, strings: int) -> DataFrame:
    """Pieces as parts of at most ``strings`` strings with a key of what these have in common.

    Strings are numbered by how far their anchor is from their start, in equal strings alike.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                place, n, body = p["place"], p["n"], p["bytes"]
                for block in range(max(0, place - n + 1) // strings, place // strings + 1):
                    far, close = block * strings + strings - 1, block * strings
                    first, last = max(0, place - far), min(n - 1, place - close)
                    if first > last:
                        continue
                    core = body[place - close : place - far + length]
                    part = body[first : last + length]
                    h = hashlib.blake2b(core + bytes((strings,)) + block.to_bytes(4, "little"), digest_size=8)
                    x = hashlib.blake2b(part, digest_size=8)
                    rows.append(
                        (p["h"], p["x"], first, p["copies"], last - first + 1, place - first)
                        + (int.from_bytes(h.digest(), "little", signed=True),)
                        + (int.from_bytes(x.digest(), "little", signed=True), part)
                    )
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            kinds += [pa.int64(), pa.int64(), pa.binary()]
            names = ["up_h", "up_x", "lo", "copies", "n", "place", "h", "x", "bytes"]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    chosen = pieces.select("h", "x", "copies", "n", "place", "bytes")
    return map_batches(
        chosen,
        cut,
        "up_h bigint, up_x bigint, lo int, copies bigint, n int, place int, h bigint, x bigint, bytes binary",
    )


def _resolved(pieces: DataFrame, length: int, finer: tuple[int, ...]) -> DataFrame:
    """``h, x, spans`` for grouped classes of pieces with their bytes, large groups included."""
    settled = pieces.where(F.col("distinct") == 1).select(
        "h", "x", F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"))).alias("spans")
    )
    several = pieces.where(F.col("distinct") > 1)
    small = _sorted(several.where(F.col("group_bytes") <= SORT_BYTES), length)
    found = settled.union(small)
    large = several.where(F.col("group_bytes") > SORT_BYTES)
    if not finer or large.isEmpty():
        return found
    parts = stored(_cut_finer(large, length, finer[0]), "parts")
    classes = parts.groupBy("h", "x").agg(
        F.sum("copies").alias("copies"),
        F.first("n").alias("n"),
        F.first("place").alias("place"),
        F.first("bytes").alias("bytes"),
    )
    grouped = stored(_grouped(classes, length), "part-groups")
    below = _resolved(grouped, length, finer[1:])
    lifted = (
        parts.select("up_h", "up_x", "lo", "h", "x")
        .join(below, ["h", "x"])
        .select("up_h", "up_x", "lo", F.explode("spans").alias("span"))
        .groupBy("up_h", "up_x")
        .agg(F.collect_list(F.struct((F.col("lo") + F.col("span.lo")).alias("lo"), (F.col("lo") + F.col("span.hi")).alias("hi"))).alias("spans"))
    )
    return found.union(lifted.select(F.col("up_h").alias("h"), F.col("up_x").alias("x"), "spans"))


def repeated_spans(named: DataFrame, length: int) -> DataFrame:
    """``doc_id, name, spans``: merged byte spans of documents covered by repeated strings."""
    pieces = stored(_pieces(named.select(*NAME, "bytes"), length), "pieces")
    where = F.struct(*NAME, "start")
    classes = pieces.groupBy("h", "x").agg(
        F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"),
        F.first("place").alias("place"),
        F.min(where).alias("at"),
    )
    grouped = stored(_grouped(classes, length), "piece-groups")
    wanted = (
        grouped.where(F.col("distinct") > 1)
        .groupBy("at.doc_id", "at.name")
        .agg(F.collect_list(F.struct("h", "x", "copies", "n", "place", "distinct", "group_bytes", F.col("at.start").alias("start"))).alias("pieces"))
    )
    copies = named.alias("d").join(wanted.alias("w"), _same_document("d", "w"))
    fetched = copies.select("d.name", "bytes", F.explode("pieces").alias("p")).select(
        "p.h", "p.x", "p.copies", "p.n", "p.place", "p.distinct", "p.group_bytes",
        F.expr(f"substring(bytes, cast(p.start + 1 as int), p.n + {length - 1})").alias("bytes"),
    )
    # Rows with one id and one text give the same pieces; one of each is enough.
    fetched = fetched.dropDuplicates(["h", "x"])
    alone = grouped.where(F.col("distinct") == 1).select(
        "h", "x", F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"))).alias("spans")
    )
    found = alone.union(_resolved(stored(fetched, "piece-bytes"), length, (38, 5, 1)))
    spans = pieces.select(*NAME, "start", "h", "x").join(found, ["h", "x"])
    spans = spans.select(*NAME, "start", F.explode("spans").alias("s")).select(
        *NAME,
        F.struct((F.col("start") + F.col("s.lo")).alias("lo"), (F.col("start") + F.col("s.hi") + F.lit(length - 1)).alias("hi")).alias("s"),
    )
    return spans.groupBy(*NAME).agg(F.collect_list("s").alias("spans"))


def _same_document(a: str, b: str):
    ids = F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
    return ids & (F.col(f"{a}.name") == F.col(f"{b}.name"))


def dedup_substrings(
    docs: DataFrame,
    *,
    length: int = 400,
    doc_id: str = "doc_id",
    text: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept``.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else, in the
    same document or another; strings are judged on the input, also where they overlap. Null
    and empty texts have nothing to remove. Rows are documents of their own also where ids
    repeat; rows with the same text lose it, if it is long enough. ``kept`` is binary, as
    cuts may fall inside a character.
    """
    named = _named(docs, doc_id, text)
    spans = repeated_spans(named, length)
    kind = named.schema["doc_id"].dataType.simpleString()
    rows = named.alias("d").join(spans.alias("s"), _same_document("d", "s"), "left")
    rows = rows.select("d.doc_id", "bytes", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", TEXT_BYTES):
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            removed, counts, kept = [], [], []
            for body, spans in zip(column("bytes").to_pylist(), column("spans").to_pylist()):
                parts, at, gone, runs = [], 0, 0, 0
                end = -1
                for span in sorted((s["lo"], s["hi"]) for s in spans or ()):
                    if span[0] > end:
                        runs += 1
                        parts.append(body[at : span[0]])
                        gone += span[1] - span[0]
                        end = span[1]
                    elif span[1] > end:
                        gone += span[1] - end
                        end = span[1]
                    at = end
                parts.append(body[at:])
                removed.append(gone)
                counts.append(runs)
                kept.append(b"".join(parts))
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            sizes = [len(k) + r for k, r in zip(kept, removed)]
            arrays = [column("doc_id")] + [pa.array(x, pa.int64()) for x in (sizes, removed, counts)]
            arrays.append(pa.array(digests, pa.string()))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return map_batches(rows, cut, schema + ", kept binary" * with_text)
