"""Shards of near equal bytes: the leaves of a k-d tree over the metadata of documents.

Built-in functions only; texts are read once, for their size and checksum. A dimension is a
column as a whole number of ``_COORDINATE`` bits: a number by its place between the least and
the greatest value, a text by a hash, so that equal values lie together. A node that stands for
several shards is cut along the dimension its documents are widest in, where the sizes on both
sides are as its shares of the shards: at the weighted median if their number is even.

The median is found without sorting: sizes are added up in ``_BUCKETS`` intervals of the keys of
every node at once, and again within the interval that holds the median, until that is one key
or weighs next to nothing. A key is the coordinate and then a hash of the id, so the rows of
one value, were they a third of the table, can be cut anywhere. Rounds see each node's numbers,
at most shards times ``_BUCKETS``, and never documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from squadbook.runtime import stored

OVERHEAD = 16
_COORDINATE, _HASH, _SALT = 20, 27, 16
_TIE = _HASH + _SALT
_CELLS = (1 << _COORDINATE) - 1
_BUCKETS = 512
# A cut may be off by this share of a shard's bytes.
_FINE = 4096
# Documents that are numbered in one group, about.
SLOT_ROWS = 16_384


@dataclass
class Node:
    """Shards ``first`` to ``first + shards - 1``; with a cut, on two sides of a key."""

    first: int
    shards: int
    dimension: int = 0
    cut: int | None = None
    left: Node | None = None
    right: Node | None = None


def _md5_bits(text: Column, bits: int) -> Column:
    digits = -(-bits // 4)
    number = F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")
    return F.shiftright(number, 4 * digits - bits)


def _coordinates(docs: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns as numbers of ``_COORDINATE`` bits; null, NaN and infinite are 0."""
    kinds = [docs.schema[c].dataType for c in columns]
    numbers = [c for c, kind in zip(columns, kinds) if isinstance(kind, NumericType)]
    finite = {}
    for c in numbers:
        value = F.col(f"`{c}`").cast("double")
        finite[c] = F.when(F.abs(value) < float("inf"), value)
    ends = {}
    if numbers:
        found = docs.agg(*[f(finite[c]) for c in numbers for f in (F.min, F.max)]).first()
        ends = {c: (found[2 * i], found[2 * i + 1]) for i, c in enumerate(numbers)}
    result = []
    for c in columns:
        if c not in ends:
            result.append(F.coalesce(_md5_bits(F.col(f"`{c}`").cast("string"), _COORDINATE), F.lit(0)))
            continue
        low, high = ends[c]
        if low is None or not 0 < high - low < float("inf"):
            result.append(F.lit(0).cast("bigint"))
            continue
        place = F.floor((finite[c] - F.lit(low)) / F.lit(high - low) * F.lit(float(_CELLS)))
        result.append(F.coalesce(place.cast("bigint"), F.lit(0)))
    return result


def _key(dimension: int) -> Column:
    return F.shiftleft(F.col(f"x{dimension}"), _TIE).bitwiseOR(F.col("tie"))


def _leaf(node: Node) -> Column:
    """The first shard of the leaf a row is in."""
    if node.cut is None:
        return F.lit(node.first)
    return F.when(_key(node.dimension) < node.cut, _leaf(node.left)).otherwise(_leaf(node.right))


def _by_leaf(values: dict[int, int], shards: int) -> Column:
    """A number for each leaf, looked up by ``node``; 0 where there is none."""
    # One foldable string, so the plan holds a single literal.
    listed = ",".join(str(values.get(i, 0)) for i in range(shards))
    return F.get(F.split(F.lit(listed), ",").cast("array<bigint>"), F.col("node"))


def _cut(rows: DataFrame, nodes: list[Node], dimensions: int, shards: int) -> list[Node]:
    """Cut the nodes of a level, whose rows carry ``node``; the new nodes that are to be cut."""
    spans = [F.max(f"x{d}") - F.min(f"x{d}") for d in range(dimensions)]
    ends = [f(_key(d)) for d in range(dimensions) for f in (F.min, F.max)]
    found = {r[0]: r[1:] for r in rows.groupBy("node").agg(F.sum("size"), *spans, *ends).collect()}
    low, high, before, total = {}, {}, {}, {}
    for node in nodes:
        if node.first in found:
            total[node.first], *measured = found[node.first]
            widths = measured[:dimensions]
            node.dimension = widths.index(max(widths))
            at = dimensions + 2 * node.dimension
            low[node.first], high[node.first] = measured[at : at + 2]
        else:
            low[node.first], high[node.first], total[node.first], node.cut = 0, 0, 0, 0
        before[node.first] = 0
    open_ = [n for n in nodes if n.cut is None]
    # As _leaf walks them, the rows of a node are told by its first shard.
    by_dimension = F.lit(0)
    for d in range(dimensions):
        held = [n.first for n in open_ if n.dimension == d]
        if held:
            by_dimension = F.when(F.col("node").isin(held), _key(d)).otherwise(by_dimension)
    keyed = rows.select("node", "size", by_dimension.alias("key"))
    while open_:
        held = [n.first for n in open_]
        step = {i: (high[i] - low[i]) // _BUCKETS + 1 for i in held}
        inside = F.col("node").isin(held) & F.col("key").between(_by_leaf(low, shards), _by_leaf(high, shards))
        bucket = F.expr("(key - low) div step").alias("bucket")
        sums = keyed.where(inside).select(
            "node", "size", "key", _by_leaf(low, shards).alias("low"), _by_leaf(step, shards).alias("step")
        )
        sums = sums.groupBy("node", bucket).agg(F.sum("size"), F.min("key"), F.max("key")).collect()
        parts: dict[int, list] = {}
        for leaf, at, size, least, most in sums:
            parts.setdefault(leaf, []).append((at, size, least, most))
        still = []
        for node in open_:
            i = node.first
            left = node.shards // 2
            for _, size, least, most in sorted(parts[i]):
                # The first interval that reaches the left side's share holds the cut.
                if (before[i] + size) * node.shards >= total[i] * left:
                    break
                before[i] += size
            if least < most and size * _FINE * node.shards > total[i]:
                low[i], high[i] = least, most
                still.append(node)
                continue
            # On whichever side of it the shares are closer.
            goes_left = (2 * before[i] + size) * node.shards <= 2 * total[i] * left
            node.cut = most + 1 if goes_left else least
        open_ = still
    children = []
    for node in nodes:
        left = node.shards // 2
        node.left = Node(node.first, left)
        node.right = Node(node.first + left, node.shards - left)
        children += [c for c in (node.left, node.right) if c.shards > 1]
    return children


def kd_shards(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = ("source", "lang", "n_chars", "doc_id"),
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    Give the number of ``shards``, or ``target_bytes`` to have as many as the sizes need. A
    document's size is that of its text in UTF-8, and ``OVERHEAD``; a null text has no bytes.
    ``slot`` numbers the documents of a shard from 0, in the order of a hash of their ids.
    The law is that shards have near equal bytes, so ``grown_shard`` is null. Of dimensions of
    equal width the first is cut. Rows with one id are documents of their own; documents of
    equal text may be in several shards. A shard has no rows where there are fewer documents
    than shards; an empty table gives an empty result. Extra columns are not looked at.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    identity = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    hashed = F.shiftleft(_md5_bits(identity, _HASH), _SALT)
    # Rows that share an id are told apart by their places.
    salt = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << _SALT) - 1))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        hashed.bitwiseOR(salt).alias("tie"),
        *[x.alias(f"x{d}") for d, x in enumerate(_coordinates(docs, dimensions))],
    )
    rows = stored(rows, "shard-rows", "zstd")
    count, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // target_bytes))
    tree = Node(0, shards)
    level = [tree] if shards > 1 and count else []
    while level:
        placed = rows.withColumn("node", _leaf(tree))
        wanted = [n.first for n in level]
        level = _cut(placed.where(F.col("node").isin(wanted)), level, len(dimensions), shards)
    placed = rows.withColumn("shard", _leaf(tree))
    return _numbered(placed, max(1, -(-count // (shards * SLOT_ROWS)))).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(placed: DataFrame, groups: int) -> DataFrame:
    """``slot`` by the order of ``tie``: within a group, behind the groups before it."""
    grouped = placed.withColumn("group", F.expr(f"cast(tie * {groups}D / {1 << _TIE} as int)"))
    sizes = grouped.groupBy("shard", "group").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "group").orderBy("tie", "doc_id", "text_crc32", "size")
    numbered = grouped.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "group"]).withColumn(
        "slot", (F.col("start") + F.col("at")).cast("bigint")
    )
