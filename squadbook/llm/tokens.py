"""Token ids of documents in a binary format with Elias-Fano encoded boundaries.

The format is a table of blocks. A block holds the ids of consecutive documents in one
array, little-endian, in the smallest width the vocabulary fits, and the ends of the
documents as an Elias-Fano sequence: the low bits of each end packed, the high bits in
unary, and a directory of 32-bit ranks for ``select``. A document's ids are found with two
selects; no table has a 64-bit number a document. Blocks are numbered within shards, and
documents ascend by id through blocks and shards.

Blocks are rows of a Parquet table, so the files are committed, listed and read by Spark on
any store it can reach.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from squadbook.llm.arrays import CHUNK, prefix_hashes, span_hashes, text_bytes
from squadbook.llm.tasks import map_batches, slices

BLOCK_IDS = 1 << 18
SHARD_BYTES = 128 << 20
# Rows of 12 bytes: what may be broadcast when blocks are read.
MAX_BROADCAST_SHARDS = 1_000_000
# Distinct pieces that a worker remembers, in about 40 MB.
MEMO = 1_000_000
RANK_BYTES = 64

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
_POPCOUNT = _BITS.sum(axis=1).astype(np.uint8)


class EliasFano:
    """A non-decreasing sequence below 2^32, in about ``2 + log2(top / n)`` bits a member."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, ranks: bytes):
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.ranks = np.frombuffer(ranks, "<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        lows = (values[:, None] >> np.arange(low_bits)) & 1
        high = np.zeros((n + (top >> low_bits) + 1 + 8 * RANK_BYTES) // (8 * RANK_BYTES) * 8 * RANK_BYTES, np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        high = np.packbits(high)
        ones = _POPCOUNT[high].reshape(-1, RANK_BYTES).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4")
        return cls(n, low_bits, np.packbits(lows.astype(np.uint8)).tobytes(), high.tobytes(), ranks.tobytes())

    def select(self, indexes: np.ndarray) -> np.ndarray:
        """Members by number: the directory names a piece of the high bits, which is searched."""
        piece = np.searchsorted(self.ranks, indexes, "right") - 1
        pieces = self.high.reshape(-1, RANK_BYTES)
        out = np.empty(len(indexes), np.int64)
        for at in range(0, len(indexes), 4096):
            which, index = piece[at : at + 4096], indexes[at : at + 4096]
            seen = np.cumsum(np.unpackbits(pieces[which], axis=1), axis=1, dtype=np.uint16)
            wanted = index - self.ranks[which] + 1
            place = (seen < wanted[:, None]).sum(axis=1) + which * (8 * RANK_BYTES)
            bit = index[:, None] * self.low_bits + np.arange(self.low_bits)
            lows = (self.low[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 if self.low_bits else np.zeros((len(index), 0), np.uint8)
            low = (lows.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
            out[at : at + 4096] = ((place - index) << self.low_bits) | low
        return out

    def span(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the given documents, where members are ends."""
        ends = self.select(index)
        starts = np.where(index > 0, self.select(np.maximum(index - 1, 0)), 0)
        return starts, ends


# Classes of bytes, for texts in which a byte-level pre-tokenizer cuts where they change:
# letters (ASCII, and both bytes of Latin letters up to U+024F), digits, marks, white space.
_LETTER, _DIGIT, _MARKS, _SPACE, _LINE, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0x21:0x7F] = _MARKS
_CLASS[0x27] = _OTHER  # an apostrophe may begin a contraction, which is cut otherwise
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x80:0xC0] = _CLASS[0xC3:0xCA] = _LETTER
_CLASS[0x20], _CLASS[0x0A] = _SPACE, _LINE


class Memo:
    """Ids of pieces by their hash: open addressing over numpy arrays, emptied when full."""

    def __init__(self, entries: int, kind: str):
        self.bits = max(4, (2 * entries - 1).bit_length())
        self.entries, self.kind = entries, kind
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.start = np.zeros(self.entries + 1, np.int64)
        self.ids = np.zeros(4 * self.entries, self.kind)
        self.n = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.slots[slot]
        wrong = np.flatnonzero((found >= 0) & (self.keys[slot] != hashes))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            here = slot[wrong]
            found[wrong] = self.slots[here]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[here] != hashes[wrong])]
        return found

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New distinct hashes, their ids one after another, and how many each has."""
        first, total = int(self.start[self.n]), int(counts.sum())
        if first + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(total, len(self.ids)), self.kind)])
        self.ids[first : first + total] = ids
        self.start[self.n + 1 : self.n + 1 + len(hashes)] = first + np.cumsum(counts)
        mask = (1 << self.bits) - 1
        for n, (slot, key) in enumerate(zip((hashes >> np.uint64(64 - self.bits)).tolist(), hashes), self.n):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot], self.keys[slot] = n, key
        self.n += len(hashes)


class Encoder:
    """Ids of the texts of a batch; equal words are encoded once and remembered.

    A byte-level pre-tokenizer cuts a text into words, numbers and marks, each with the space
    ahead of it, before anything is merged, so these can be encoded apart. The cut is made
    here only in texts of printable ASCII and Latin letters with single spaces and line ends
    between, where it is plain; every other text is encoded whole, as is one that holds an
    added token or an apostrophe.
    """

    def __init__(self, tokenizer_json: str, kind: str):
        from tokenizers import Tokenizer, pre_tokenizers

        # One thread a task; the others belong to other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.kind = Tokenizer.from_str(tokenizer_json), kind
        self.memo = Memo(MEMO, kind)
        parts = json.loads(tokenizer_json)
        cutter = parts.get("pre_tokenizer") or {}
        self.added = [t["content"].encode() for t in parts.get("added_tokens", [])]
        # The same merges for words that are cut already, and the bytes each id stands for.
        self.merges = Tokenizer.from_str(tokenizer_json)
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        spelled = {i: len(t) for t, i in self.tokenizer.get_vocab().items()}
        self.bytes_of = np.array([spelled.get(i, 0) for i in range(max(spelled, default=0) + 1)])
        self.by_piece = (
            parts.get("normalizer") is None
            and cutter.get("type") == "ByteLevel"
            and bool(cutter.get("use_regex", True))
            and not cutter.get("add_prefix_space", True)
        )

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts may be cut by classes of bytes."""
        kind = _CLASS[data]
        gap = kind >= _SPACE
        bad = kind == _OTHER
        bad[1:] |= gap[1:] & gap[:-1]
        # Not letters: the signs for times and divided by.
        bad[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        filled = offsets[1:] > offsets[:-1]
        bad[offsets[:-1][filled]] |= gap[offsets[:-1][filled]]
        bad[offsets[1:][filled] - 1] |= gap[offsets[1:][filled] - 1]
        total = np.concatenate(([0], np.cumsum(bad)))
        plain = total[offsets[1:]] == total[offsets[:-1]]
        if self.added and plain.any():
            buffer = data.tobytes()
            for token in self.added:
                at = buffer.find(token)
                while at >= 0:
                    plain[np.searchsorted(offsets, at, "right") - 1] = False
                    at = buffer.find(token, at + 1)
        return plain

    def new_pieces(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces of these numbers of bytes, one after another, and how many each has."""
        coded = self.merges.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(coded[0].ids, self.kind)
        ends = np.cumsum(self.bytes_of[ids])
        stops = np.searchsorted(ends, np.cumsum(sizes), "left") + 1
        if len(ids) and stops[-1] == len(ids) and (ends[stops - 1] == np.cumsum(sizes)).all():
            return ids, np.diff(stops, prepend=0)
        each = [self.whole(p) for p in pieces]
        return np.concatenate(each), np.array([len(x) for x in each])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a batch."""
        out: list = [None] * (len(offsets) - 1)
        plain = self.plain(data, offsets) if self.by_piece and len(data) else np.zeros(len(out), bool)
        for row in np.flatnonzero(~plain).tolist():
            out[row] = self.whole(data[offsets[row] : offsets[row + 1]].tobytes().decode())
        if not plain.any():
            return out
        kind = _CLASS[data]
        begins = np.ones(len(data), bool)
        begins[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        used = np.repeat(plain, np.diff(offsets))
        starts = np.flatnonzero(begins & used)
        after = np.append(np.flatnonzero(begins), len(data))
        ends = after[np.searchsorted(after, starts, "right")]
        hashes = np.empty(len(starts), np.uint64)
        for lo in range(0, len(data), CHUNK):
            some = slice(*np.searchsorted(starts, (lo, lo + CHUNK)))
            if some.start < some.stop:
                hi = int(ends[some.stop - 1])
                sums = prefix_hashes(data[lo:hi])
                hashes[some] = span_hashes(sums, starts[some] - lo, ends[some] - lo)
        entry = self.memo.find(hashes)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            fresh, one = np.unique(hashes[missing], return_index=True)
            if self.memo.n + len(fresh) > self.memo.entries:
                self.memo.clear()
                fresh, one = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
                if len(fresh) > self.memo.entries:
                    self.memo = Memo(2 * len(fresh), self.kind)
            self._remember(data, starts[missing[one]], ends[missing[one]], fresh)
            entry[missing] = self.memo.find(hashes[missing])
        first = self.memo.start[entry]
        counts = self.memo.start[entry + 1] - first
        stops = np.cumsum(counts)
        ids = self.memo.ids[np.repeat(first - (stops - counts), counts) + np.arange(int(stops[-1]) if len(stops) else 0)]
        bounds = np.concatenate(([0], stops))[np.searchsorted(starts, offsets)]
        for row in np.flatnonzero(plain).tolist():
            out[row] = ids[bounds[row] : bounds[row + 1]]
        return out

    def _remember(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        buffer = data.tobytes()
        pieces = [buffer[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        self.memo.add(hashes, *self.new_pieces(pieces, ends - starts))


_encoders: dict[tuple[int, str], Encoder] = {}

BLOCKS = (
    "shard int, block int, first_id bigint, n_ids bigint, n_docs int, n_null int, doc_ids binary, "
    "width int, ids binary, low_bits int, low binary, high binary, ranks binary"
)
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = [part.split()[0] for part in BLOCKS.split(", ")]


def _block(shard: int, number: int, first: int, doc_ids: list, ids: list[bytes], width: int) -> tuple:
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    coded = EliasFano.encode(ends)
    nulls = sum(x is None for x in doc_ids)
    keys = np.array([x for x in doc_ids if x is not None], "<i8").tobytes()
    return (shard, number, first, int(ends[-1]), len(ids), nulls, keys, width, b"".join(ids), coded.low_bits, coded.low.tobytes(), coded.high.tobytes(), coded.ranks.tobytes())


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    *,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> int:
    """Encode every text, append ``end_id``, and write blocks below ``path``; returns the shards.

    Documents are dealt by ranges of their id (ties by a hash of the text, so that a retried
    task gives the same order), rows without id first. A null text has the end id alone. Ids are
    whole numbers; of another type they are cast, which fails or gives null by ANSI mode.
    Documents are encoded behind the exchange, in streams of blocks: a task holds one block.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer_json = file.read()
    top = max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1)
    width = 2 if top <= 1 << 16 else 4
    held = spark.sparkContext.broadcast(tokenizer_json)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = f"<u{width}"
        key = (zlib.crc32(held.value.encode()), kind)
        if key not in _encoders:
            _encoders[key] = Encoder(held.value, kind)
        encoder, end = _encoders[key], np.array([end_id], kind).tobytes()
        shard = TaskContext.get().partitionId()
        number = first = held_ids = 0
        keys: list = []
        ids: list[bytes] = []

        def emit() -> pa.RecordBatch:
            row = _block(shard, number, first, keys, ids, width)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES)], _NAMES)

        for batch in slices(batches, "text", 1 << 19):
            found = encoder.encode(*text_bytes(batch.column(1)))
            for k, x in zip(batch.column(0).to_pylist(), found):
                coded = x.tobytes() + end
                keys.append(k)
                ids.append(coded)
                held_ids += len(coded) // width
                if held_ids >= BLOCK_IDS:
                    yield emit()
                    number, first, held_ids = number + 1, first + held_ids, 0
                    keys, ids = [], []
        if ids:
            yield emit()

    map_batches(ordered, blocks, BLOCKS).write.mode("errorifexists").parquet(path)
    return shards


def block_documents(blocks: pa.RecordBatch) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block: its row, ids of documents, starts, ends, and the token ids."""
    for row, b in enumerate(blocks.to_pylist()):
        bounds = EliasFano(b["n_docs"], b["low_bits"], b["low"], b["high"], b["ranks"])
        starts, ends = bounds.span(np.arange(b["n_docs"]))
        keys = [None] * b["n_null"] + np.frombuffer(b["doc_ids"], "<i8").tolist()
        yield row, keys, starts, ends, np.frombuffer(b["ids"], f"<u{b['width']}")


def read_token_index(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    Starts count the ids of all documents before. Shards are numbered in order, so one row a
    shard (of 12 bytes; broadcast up to a million of them) is summed up, never a row a document.
    """
    table = spark.read.schema(BLOCKS).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy("shard")
        .agg(F.sum("n_ids").alias("ids_of_shard"))
        .select("shard", F.coalesce(F.sum("ids_of_shard").over(before), F.lit(0)).alias("offset"))
    )
    if shards <= MAX_BROADCAST_SHARDS:
        offsets = F.broadcast(offsets)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            first, shard = batch.column("first_id").to_pylist(), batch.column("shard").to_pylist()
            for row, keys, starts, ends, ids in block_documents(batch):
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(starts.tolist(), ends.tolist())
                ]
                arrays = [
                    pa.array([shard[row]] * len(keys), pa.int32()),
                    pa.array(keys, pa.int64()),
                    pa.array(starts + first[row], pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    documents = map_batches(
        table, index, "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return documents.join(offsets, "shard").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
