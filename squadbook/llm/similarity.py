"""Join of documents that share most of their runs of five words, as components of links.

A document's set holds the hashes of its distinct word runs; two documents link when their
sets have at least ``percent`` of their union in common. The steps:

1. Equal sets become one class. Each has a size and a sketch that bounds overlaps.
2. Similar sets share one of the first members (about a fifth) in any order common to all
   sets, so these prefixes are indexed. Members that many classes have come last in the
   order. Members with the same classes are one group.
3. Sizes and sketches rule out most pairs of a group; what is left hangs together in blocks.
4. The sets of a block go to one task, which answers a T-occurrence search for each of them
   over inverted lists (``overlap.InvertedLists``). Groups and blocks beyond a bound are cut
   into slices, every pair of which is a unit of its own.
5. Links (a spanning forest, never all pairs of copies) give the components.

Sets are of 64-bit hashes; classes are told apart by a 64-bit hash of set and size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadbook.llm.arrays import BETWEEN_SPACES, LOWER, mix, shingle_sets, text_bytes, words
from squadbook.llm.components import components
from squadbook.llm.filters import without_rows
from squadbook.llm.overlap import candidate_links, similar_links, sketch
from squadbook.llm.tasks import map_batches, slices, sorted_groups
from squadbook.runtime import forget_shuffles, stored

TEXT_BYTES = 1 << 20
# Sets a task holds while it looks for members that many of them have.
COUNTED_SETS = 2000
# Members that may be moved to the end of the order: 8 bytes each on the driver and in tasks.
MAX_FREQUENT = 200_000
MIN_FREQUENT = 64
# Members of prefixes in a bucket; classes in a slice of a group; set members in a unit.
BUCKET_MEMBERS = 1 << 20
SLICE_CLASSES = 2048
SLICE_MEMBERS = 1 << 21


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    column = batch.column(batch.schema.get_field_index("text"))
    data, offsets = text_bytes(column)
    yield from shingle_sets(words(data, offsets, BETWEEN_SPACES, LOWER), width)


def class_of(members: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    with np.errstate(over="ignore"):
        total = mix(members).sum(dtype=np.uint64) + np.uint64(len(members))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


_MEASURES = ["kind", "row", "doc_id", "n", "c", "sketch"]


def _measured(docs: DataFrame, width: int) -> DataFrame:
    """Rows of documents (``kind`` 0: id, size, class, sketch) and of frequent members (1)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in slices(batches, "text", TEXT_BYTES):
            sizes, classes, sketches = [], [], []
            for members in _sets(batch, width):
                sizes.append(len(members))
                classes.append(class_of(members) if len(members) else None)
                sketches.append(sketch(members) if len(members) else None)
                if len(members):
                    held[classes[-1]] = members
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * n, pa.int32())]
                + [batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id")]
                + [pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary())],
                _MEASURES,
            )
            if len(held) >= COUNTED_SETS:
                yield _frequent(held)
                held = {}
        if held:
            yield _frequent(held)

    return map_batches(
        docs, measure, "kind int, row bigint, doc_id bigint, n bigint, c bigint, sketch binary"
    )


def _frequent(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    members, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
    some = counts >= 4
    n = int(some.sum())
    return pa.RecordBatch.from_arrays(
        [pa.array([1] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
        + [pa.array(counts[some], pa.int64()), pa.array(members[some].view(np.int64))]
        + [pa.nulls(n, pa.binary())],
        _MEASURES,
    )


def frequent_members(measured: DataFrame) -> np.ndarray:
    """The most frequent members of sets, rarest first; at most ``MAX_FREQUENT``.

    Counts are of members that several of the sets a task held had; whichever members are
    found, the order is one for all sets, and only the cost depends on it.
    """
    counts = (
        measured.where("kind = 1")
        .groupBy("c")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= MIN_FREQUENT)
        .orderBy(F.desc("n"), "c")
        .limit(MAX_FREQUENT)
    )
    return np.array([r["c"] for r in counts.collect()][::-1], np.int64).view(np.uint64)


def prefix(members: np.ndarray, percent: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first members in the common order, one of which any similar set has as well.

    The order is by hash, with the frequent members (sorted, with their ranks) at the end.
    """
    n = len(members)
    length = n - -(-percent * n // 100) + 1
    place = np.searchsorted(frequent, members)
    place[place == len(frequent)] = 0
    last = frequent[place] == members if len(frequent) else np.zeros(n, bool)
    first = members[~last][:length]
    if len(first) < length:
        late = members[last][np.argsort(rank[place[last]], kind="stable")]
        first = np.concatenate([first, late[: length - len(first)]])
    return first


def _groups(docs: DataFrame, width: int, percent: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """``g, slices, slice, classes``: distinct groups of classes that share a prefix member."""
    order = np.argsort(frequent)
    held = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Prefixes of many texts as one row a bucket: members and classes side by side."""
        ordered, rank = held.value
        parts: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        size = 0
        seen: set[int] = set()

        def emit() -> pa.RecordBatch:
            members, classes = np.concatenate(parts), np.concatenate(owners)
            # Not by the leading bits: prefixes are of members with small hashes.
            bucket = ((members & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            members, classes, bucket = members[by], classes[by], bucket[by]
            used, starts = np.unique(bucket, return_index=True)
            ends = np.append(starts[1:], len(bucket))
            spans = list(zip(starts.tolist(), ends.tolist()))
            return pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array([members[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([classes[a:b].tobytes() for a, b in spans], pa.binary())],
                ["bucket", "members", "classes"],
            )

        for batch in slices(batches, "text", TEXT_BYTES):
            for members in _sets(batch, width):
                if not len(members):
                    continue
                c = class_of(members)
                if c in seen:
                    continue
                seen.add(c)
                parts.append(prefix(members, percent, ordered, rank))
                owners.append(np.full(len(parts[-1]), c, np.int64))
                size += len(parts[-1])
            if size >= BUCKET_MEMBERS:
                yield emit()
                parts, owners, size, seen = [], [], 0, set()
        if parts:
            yield emit()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in sorted_groups(batches, "bucket"):
            members = np.frombuffer(b"".join(table["members"].to_pylist()), np.uint64)
            classes = np.frombuffer(b"".join(table["classes"].to_pylist()), np.int64)
            by = np.lexsort((classes, members))
            members, classes = members[by], classes[by]
            fresh = np.ones(len(members), bool)
            fresh[1:] = (members[1:] != members[:-1]) | (classes[1:] != classes[:-1])
            members, classes = members[fresh], classes[fresh]
            starts = np.flatnonzero(np.concatenate(([True], members[1:] != members[:-1])))
            ends = np.append(starts[1:], len(members))
            several = np.flatnonzero(ends - starts > 1)
            found: dict[int, np.ndarray] = {}
            for a, b in zip(starts[several].tolist(), ends[several].tolist()):
                some = classes[a:b]
                found.setdefault(class_of(some.view(np.uint64)), some)
            rows = []
            for g, some in found.items():
                n = -(-len(some) // SLICE_CLASSES)
                rows += [(g, n, k, some[k::n]) for k in range(n)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
                    ["g", "slices", "slice", "classes"],
                )

    dealt = map_batches(docs.select("text"), index, "bucket bigint, members binary, classes binary")
    dealt = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    groups = map_batches(dealt, gather, "g bigint, slices int, slice int, classes array<bigint>")
    return groups.dropDuplicates(["g", "slice"])


def paired_slices(rows: DataFrame, group: str) -> DataFrame:
    """``unit`` for every pair of slices of a group that a row's slice is in.

    A group of one slice is one unit. The rows of a group of ``s`` slices are repeated ``s``
    times; a unit holds two slices at most.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    pairs = rows.select("*", other)
    low, high = F.least("slice", "other"), F.greatest("slice", "other")
    return pairs.withColumn("unit", F.xxhash64(group, low, high)).drop("other", "slice", "slices")


def _candidates(groups: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    units = paired_slices(groups, "g").select("unit", F.explode("classes").alias("c"))
    dealt = units.join(sketches, "c").repartition("unit").sortWithinPartitions("unit")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: set[tuple[int, int]] = set()
        for _, table in sorted_groups(batches, "unit"):
            classes = table["c"].to_numpy()
            links = candidate_links(table["n"].to_numpy(), table["sketch"].to_pylist(), percent)
            out.update((int(classes[i]), int(classes[j])) for i, j in links if classes[i] != classes[j])
            if len(out) > 100_000:
                yield _pairs(out)
                out = set()
        yield _pairs(out)

    return map_batches(dealt, compare, "a bigint, b bigint").distinct()


def _pairs(found) -> pa.RecordBatch:
    rows = np.array(sorted(found), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])


def _links(docs: DataFrame, blocks: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b``: links among the classes of each block."""
    members = blocks.withColumnsRenamed({"node": "c", "component": "block"}).join(classes, "c")
    sizes = members.groupBy("block").agg(
        F.ceil(F.sum("n") / F.lit(SLICE_MEMBERS)).cast("int").alias("slices")
    )
    members = members.join(sizes, "block").select("block", "c", "slices", F.col("doc_id").alias("id"))
    fetched = docs.join(members, docs["doc_id"].eqNullSafe(members["id"])).select(
        "block", "c", "slices", F.pmod(F.xxhash64("c"), F.col("slices")).cast("int").alias("slice"), "text"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            sets = list(_sets(batch, width))
            column = lambda x: batch.column(batch.schema.get_field_index(x))
            wanted = column("c").to_pylist()
            # Rows that share the id of a class's document but not its text are left out.
            same = pa.array([len(s) > 0 and class_of(s) == c for s, c in zip(sets, wanted)], pa.bool_())
            names = ["block", "c", "slices", "slice"]
            arrays = [column(x) for x in names] + [pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names + ["members"]).filter(same)

    built = map_batches(fetched, build, "block bigint, c bigint, slices int, slice int, members binary")
    dealt = paired_slices(built, "block").repartition("unit").sortWithinPartitions("unit")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in sorted_groups(batches, "unit"):
            sets = dict(zip(table["c"].to_pylist(), table["members"].to_pylist()))
            found = similar_links([np.frombuffer(s, np.uint64) for s in sets.values()], percent)
            names = list(sets)
            yield _pairs({(names[i], names[j]) for i, j in found})

    return map_batches(dealt.select("unit", "c", "members"), search, "a bigint, b bigint").distinct()


def similar_groups(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """``row, doc_id, n, root`` for ``row, doc_id, text``; rows that links join have one root.

    The root is null where a text has no words.
    """
    measured = stored(_measured(docs, width), "sets")
    documents = measured.where("kind = 0").select("row", "doc_id", "n", "c")
    by_class = measured.where("kind = 0 and c is not null").groupBy("c")
    classes = by_class.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    sketches = by_class.agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    total = documents.agg(F.sum("n")).first()[0] or 0
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, total * (100 - percent) // 100 // BUCKET_MEMBERS + 1)
    groups = _groups(docs, width, percent, frequent_members(measured), buckets)
    # Prefixes, sketches and the sets of blocks are shuffled one after another.
    forget_shuffles(docs.sparkSession)
    candidates = stored(_candidates(groups, sketches, percent), "candidates")
    forget_shuffles(docs.sparkSession)
    links = stored(_links(docs, components(candidates), classes, width, percent), "links")
    forget_shuffles(docs.sparkSession)
    linked = components(links).withColumnsRenamed({"node": "c", "component": "root"})
    return documents.join(linked, "c", "left").select(
        "row", "doc_id", "n", F.coalesce("root", "c").alias("root")
    )


def similar_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Words are runs of anything but white space, A-Z folded. ``component_id`` is the smallest
    id that links lead to, the row's own included. A null text, or one without words, has an
    empty set and no links, not even to another one. Rows that share an id are documents of
    their own; rows without id take part, and where a component has no id its rows have none.
    Ids are whole numbers; of another type they are cast, which fails or gives null by ANSI mode.
    An empty table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(
        F.lit(None).cast("bigint").alias("row"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )
    placed = similar_groups(rows, width=width, percent=percent)
    # Stored apart, groups of one row left out, so that the join can split a root's many rows.
    least = placed.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")
    )
    least = stored(least.where("rows > 1").drop("rows"), "least-ids")
    return placed.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs``, all columns, without those that an earlier row links to.

    Of each group the row with the smallest id stays (the first of equals, rows without id
    last); rows whose text has no words stay.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    rows = stored(rows, "documents", "zstd")
    compared = rows.select(
        "row",
        F.col(f"doc.`{doc_id}`").cast("bigint").alias("doc_id"),
        F.col(f"doc.`{text}`").cast("string").alias("text"),
    )
    placed = similar_groups(compared, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    stay = placed.where("root is not null").groupBy("root").agg(first).select("first.row")
    stay = stay.union(placed.where("root is null").select("row"))
    gone = stored(placed.select("row").join(stay, "row", "left_anti"), "linked-rows")
    return without_rows(rows, gone, "row").select("doc.*")
