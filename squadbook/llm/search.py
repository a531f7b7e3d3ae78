"""Ranked lexical search: the highest-scoring documents of every item.

Terms are runs of ASCII letters, digits and bytes beyond ASCII, with A-Z lower-cased. The steps:

1. Items are cut into terms; their distinct terms are the only ones that documents are indexed
   by. Items go in slices of about ``SLICE_TERMS`` terms, so what tasks are given is bounded.
2. Every task turns its documents into blocks: ids in ascending order, lengths, and an inverted
   list (documents, occurrences) for each term of an item. The blocks are stored.
3. Document counts of terms and the totals ``N`` and ``L`` are summed from the blocks.
4. Every block answers every item by a hybrid search (``search_block``): short lists are added
   up term at a time; their sums are one list more, with one bound, in a search that goes
   through the documents in order and skips where the bounds of the lists say so.
5. Each task's best of an item are merged.

A null or empty text has no terms. Rows of ``documents`` with one id are documents of their own,
and so are rows of ``items``. Equal scores go by ascending id, rows without an id last. Extra
columns are not looked at. Ids are integers; other types are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from squadbook.llm.arrays import ALPHANUMERIC, LOWER, text_bytes, words
from squadbook.llm.tasks import map_batches, slices
from squadbook.runtime import stored

TEXT_BYTES = 2 << 20
# Terms of items that tasks are given at a time: 8 bytes each, and as much for weights.
SLICE_TERMS = 500_000
# A block is full with so many documents or postings.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
# Lists of at most this length are added up term at a time.
SHORT = 128
# Documents that the search looks at together: first, and once it has a threshold.
FIRST_WINDOW, WINDOW = 64, 1024
# Tasks' best are merged in so many parts of an item first.
_SALTS = 64
_NO_ID = np.iinfo(np.int64).max

_BLOCK = (
    "n_docs bigint, n_terms bigint, ids array<bigint>, lengths array<bigint>, "
    "terms array<int>, counts array<bigint>, docs array<int>, tfs array<bigint>"
)


def _terms_of(column: pa.Array):
    data, offsets = text_bytes(column)
    return words(data, offsets, ALPHANUMERIC, LOWER)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, item_id, terms``: the distinct terms of every row, as 64-bit hashes."""
    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(item_id).alias("item_id"),
        F.col(text).cast("string").alias("text"),
    )
    kind = rows.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            found = _terms_of(batch.column(2))
            lists = [
                np.unique(found.hashes[lo:hi]).view(np.int64)
                for lo, hi in zip(found.first[:-1], found.first[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))],
                ["item", "item_id", "terms"],
            )

    return map_batches(rows, cut, f"item bigint, item_id {kind}, terms array<bigint>")


class _Block:
    """Documents of a task, gathered until there are enough of them."""

    def __init__(self):
        self.ids, self.missing, self.lengths, self.docs, self.terms, self.tfs = [], [], [], [], [], []
        self.n, self.postings = 0, 0

    def add(self, ids: pa.Array, lengths: np.ndarray, docs: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        self.ids.append(ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False))
        self.missing.append(np.asarray(ids.is_null()))
        self.lengths.append(lengths)
        self.docs.append(docs + self.n)
        self.terms.append(terms)
        self.tfs.append(tfs)
        self.n += len(lengths)
        self.postings += len(docs)

    def row(self) -> pa.RecordBatch:
        """One row: documents by ascending id, postings by term and document."""
        ids, missing = np.concatenate(self.ids), np.concatenate(self.missing)
        lengths, docs = np.concatenate(self.lengths), np.concatenate(self.docs)
        terms, tfs = np.concatenate(self.terms), np.concatenate(self.tfs)
        order = np.lexsort((missing, ids))
        place = np.empty(self.n, np.int64)
        place[order] = np.arange(self.n)
        by_term = np.lexsort((place[docs], terms))
        held, counts = np.unique(terms, return_counts=True)
        values = [
            [int((lengths > 0).sum())],
            [int(lengths.sum())],
            [pa.array(ids[order], mask=missing[order])],
            [lengths[order]],
            [held.astype(np.int32)],
            [counts.astype(np.int64)],
            [place[docs][by_term].astype(np.int32)],
            [tfs[by_term]],
        ]
        big, small = pa.list_(pa.int64()), pa.list_(pa.int32())
        types = [pa.int64(), pa.int64(), big, big, small, big, small, big]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)


def index_blocks(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Blocks of ``doc_id, text`` rows; ``vocabulary`` has the sorted hashes of the terms to list."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        block = _Block()
        for batch in slices(batches, "text", TEXT_BYTES):
            found = _terms_of(batch.column(1))
            at = np.minimum(np.searchsorted(known, found.hashes), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == found.hashes) if len(known) else np.zeros(0, np.int64)
            doc = np.searchsorted(found.first, hit, "right") - 1
            pairs, tfs = np.unique(doc * len(known) + at[hit], return_counts=True)
            doc, term = np.divmod(pairs, max(len(known), 1))
            block.add(batch.column(0), np.diff(found.first), doc, term, tfs.astype(np.int64))
            if block.n >= BLOCK_DOCS or block.postings >= BLOCK_POSTINGS:
                yield block.row()
                block = _Block()
        if block.n:
            yield block.row()

    return map_batches(docs, index, _BLOCK)


class Best:
    """The highest scores so far; equal ones by ascending id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a document has to score to get in; with just that, by its id."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        ids, missing = np.concatenate((self.ids, ids)), np.concatenate((self.missing, missing))
        order = np.lexsort((missing, ids, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of documents and scores added up to one list, a term at a time."""
    docs = np.concatenate([d for d, _ in lists])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    starts = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    return docs[starts], np.add.reduceat(np.concatenate([s for _, s in lists])[order], starts)


def _probe(docs: np.ndarray, scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The scores of the wanted documents in a list; 0 for those it does not hold."""
    at = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
    return np.where(docs[at] == wanted, scores[at], 0)


def search_block(
    lists: list[tuple[np.ndarray, np.ndarray, int]],
    ids: np.ndarray,
    missing: np.ndarray,
    best: Best,
    short: int = SHORT,
) -> None:
    """Offer ``best`` the documents of a block that may be among the highest.

    ``lists`` has, for each term of an item, its documents in ascending order, what the term
    adds to their scores and the most of that. Short lists become one, with its own bound.
    Then documents are looked at in ascending order, a window at a time: only those in lists
    that can lift one over the threshold are gone through, the others are probed for what
    could still get in, and windows between them are skipped.
    """
    few = [(d, s) for d, s, _ in lists if len(d) <= short]
    lists = [x for x in lists if len(x[0]) > short]
    if few:
        docs, scores = summed(few)
        lists.append((docs, scores, int(scores.max())))
    lists.sort(key=lambda x: x[2])
    bounds = np.cumsum([x[2] for x in lists])
    seen, window = -1, FIRST_WINDOW if best.least <= 1 else WINDOW
    while True:
        # Documents that only the first lists hold stay below the threshold.
        probed = int(np.searchsorted(bounds, best.least, "left"))
        walked, at = lists[probed:], []
        for docs, _, _ in walked:
            at.append(int(np.searchsorted(docs, seen, "right")))
        ends = [int(x[0][i + window - 1]) for x, i in zip(walked, at) if i + window <= len(x[0])]
        end = min(ends, default=len(ids))
        parts = [x[0][i : np.searchsorted(x[0], end, "right")] for x, i in zip(walked, at)]
        found = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        if not len(found):
            return
        scores = np.zeros(len(found), np.int64)
        for docs, adds, _ in walked:
            scores += _probe(docs, adds, found)
        for k in range(probed - 1, -1, -1):
            open_ = scores + bounds[k] >= best.least
            found, scores = found[open_], scores[open_]
            scores = scores + _probe(lists[k][0], lists[k][1], found)
        enough = scores >= best.least
        if enough.any():
            found, scores = found[enough], scores[enough]
            best.offer(scores, ids[found], missing[found])
        seen, window = end, WINDOW


def term_weight(documents: int, holding: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _answers(blocks: DataFrame, items: list, weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """``item, doc_id, score``: each task's best of every item."""
    held = blocks.sparkSession.sparkContext.broadcast((items, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = held.value
        found: dict[int, Best] = {}
        place = np.full(len(weight), -1, np.int64)
        for batch in batches:
            # A row at a time: a block is large.
            for i in range(batch.num_rows):
                value = {c: batch.column(j)[i].values for j, c in enumerate(batch.schema.names) if j > 1}
                array = {c: v.to_numpy(zero_copy_only=False) for c, v in value.items() if c != "ids"}
                if not len(array["terms"]):
                    continue
                missing = np.asarray(value["ids"].is_null())
                ids = value["ids"].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                docs, tfs = array["docs"], array["tfs"]
                m = 10 + (90 * array["lengths"] * n) // total
                parts = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs])
                ends = np.cumsum(array["counts"])
                starts = ends - array["counts"]
                most = np.maximum.reduceat(parts, starts) * weight[array["terms"]]
                place[array["terms"]] = np.arange(len(starts))
                for item, terms in asked:
                    at = place[terms]
                    at = at[at >= 0]
                    at = at[most[at] > 0]
                    best = found.get(item) or Best(k)
                    if not len(at) or int(most[at].sum()) < best.least:
                        continue
                    found[item] = best
                    lists = []
                    for j in at.tolist():
                        lo, hi = starts[j], ends[j]
                        lists.append((docs[lo:hi], parts[lo:hi] * weight[array["terms"][j]], int(most[j])))
                    search_block(lists, ids, missing, best)
                place[array["terms"]] = -1
        for item, best in found.items():
            if len(best.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(best.scores), pa.int64()),
                        pa.array(best.ids, pa.int64(), mask=best.missing),
                        pa.array(best.scores, pa.int64()),
                    ],
                    ["item", "doc_id", "score"],
                )

    return map_batches(blocks, search, "item bigint, doc_id bigint, score bigint")


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    slice_terms: int = SLICE_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of every item.

    A term adds ``w * ((10^9 tf) div (1000 tf + 8 m))``, with the weight ``term_weight`` and
    ``m = 10 + (90 n N) div L`` for a document of ``n`` terms; documents that score 0 are left
    out. Items without terms, and tables without documents that have any, give no rows.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[doc_id].dataType, IntegralType):
        raise TypeError(f"{doc_id} has to be an integer, not {docs.schema[doc_id].dataType.simpleString()}")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = stored(item_terms(items, item_id, item_text), "search-items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_slices = max(1, -(-size // slice_terms))
    found = None
    for part in range(n_slices):
        here = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_slices)) == part).where(F.size("terms") > 0)
        # Bounded by ``slice_terms``, and by the text of the longest item.
        chosen = [(r["item"], np.array(r["terms"], np.int64).view(np.uint64)) for r in here.select("item", "terms").collect()]
        if not chosen:
            continue
        vocabulary = np.unique(np.concatenate([t for _, t in chosen]))
        blocks = stored(index_blocks(texts, vocabulary), "search-blocks", "zstd")
        sums = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not sums[0]:
            continue
        listed = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        holding = listed.groupBy("t.terms").agg(F.sum("t.counts"))
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in holding.collect():
            weights[term] = term_weight(sums[0], df)
        asked_here = [(item, np.searchsorted(vocabulary, terms)) for item, terms in chosen]
        answers = _answers(blocks, asked_here, weights, sums[0], sums[1], k)
        found = answers if found is None else found.unionByName(answers)
    if found is None:
        found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.spark_partition_id() % _SALTS)
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    merged = few.where(F.col("rank") <= k).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))
    )
    top = merged.where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
