"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

A text is a lattice: an edge for every vocabulary piece that stands at a place. The forward
pass sums, for each place, the weights of all ways to it; the backward pass walks from the
end, drawing each edge with its share of that sum, so that segmentations come out with
probability in proportion to their weight. No piece crosses the start of a word, so the
lattice falls apart into words, equal words share their forward pass, and all words of a
batch are walked side by side. Draws are a hash of the row's key and the place in the text:
a row gives the same ids whatever batch, task or attempt it is in.

Characters without a piece become byte pieces. So does the space mark where it stands in
the text itself, which is why decoding gives back every text, byte by byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadbook.llm.arrays import mix, prefix_hashes, span_hashes
from squadbook.llm.tasks import map_batches, slices

MARK = 0x2581
# Stands for a space mark in the text itself; beyond all code points, so it has no piece.
_LITERAL_MARK = 0x110000
_TABLE_BITS = 20
# Characters that are worked on at a time; a word or line that is longer stays whole.
STRETCH = 1 << 18


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Vocabulary:
    """Pieces of a SentencePiece model with a weight each, and bytes for decoding."""

    def __init__(self, model: bytes):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = processor.get_piece_size()
        scores = np.array([processor.get_score(i) for i in range(size)])
        if scores.min() < -1000:
            # A merge model scores a piece by its rank; by rank, frequencies fall as 1/rank.
            scores = -np.log1p(np.minimum(-scores, size))
        spelled: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, np.int64)
        ids, hashes, lengths, single = [], [], [], []
        for i in range(size):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                spelled[i] = bytes([value])
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                spelled[i] = piece.replace(chr(MARK), " ").encode()
                points = _points(piece)
                sums = prefix_hashes(points)
                hashes.append(span_hashes(sums, np.array([0]), np.array([len(points)]))[0])
                ids.append(i)
                lengths.append(len(points))
                if len(points) == 1:
                    single.append(int(points[0]))
        self.longest = max(lengths, default=1)
        self.ids, self.scores = np.array(ids, np.int64), scores.astype(np.float64)
        self.hashes = np.array(hashes, np.uint64)
        # Open addressing over the high bits; a slot holds a number in ``ids`` plus one.
        self.slots = np.zeros(1 << _TABLE_BITS, np.int32)
        for n, h in enumerate((self.hashes >> np.uint64(64 - _TABLE_BITS)).tolist()):
            while self.slots[h]:
                h = (h + 1) % len(self.slots)
            self.slots[h] = n + 1
        self.has_piece = np.zeros(0x110001, bool)
        self.has_piece[single] = True
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.array([len(s) for s in spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers in ``ids`` of pieces with these hashes, -1 where there is none."""
        slot = (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        found = np.full(len(hashes), -1, np.int64)
        number = self.slots[slot]
        open_ = np.flatnonzero(number)
        while len(open_):
            n = number[open_] - 1
            same = self.hashes[n] == hashes[open_]
            found[open_[same]] = n[same]
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) % len(self.slots)
            number[open_] = self.slots[slot[open_]]
            open_ = open_[number[open_] > 0]
        return found

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the text that the ids spell, without the leading space of the first word."""
        sizes = self.spelled_length[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        within = np.arange(total) - np.repeat(ends - sizes, sizes)
        return self.spelled[np.repeat(self.spelled_start[ids], sizes) + within].tobytes()[1:]


class _Lattice:
    """Edges into every place of every distinct word, with the odds of drawing each."""

    def __init__(self, vocabulary: Vocabulary, points: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Words are spans of ``points``; all of their characters have pieces."""
        sizes = ends - starts
        self.node = np.cumsum(sizes + 1) - (sizes + 1)
        total = int((sizes + 1).sum())
        sums = prefix_hashes(points)
        # All spans of up to the longest piece, by length.
        first = np.repeat(starts, sizes) + _within(sizes)
        last = np.repeat(ends, sizes)
        node = np.repeat(self.node, sizes) + _within(sizes)
        edges = []
        for length in range(1, vocabulary.longest + 1):
            fits = first + length <= last
            first, last, node = first[fits], last[fits], node[fits]
            if not len(first):
                break
            found = vocabulary.find(span_hashes(sums, first, first + length))
            hit = np.flatnonzero(found >= 0)
            edges.append((node[hit], np.full(len(hit), length), found[hit]))
        source, length, number = (np.concatenate(x) for x in zip(*edges))
        piece = vocabulary.ids[number]
        target = source + length
        order = np.argsort(target, kind="stable")
        source, length, piece, target = source[order], length[order], piece[order], target[order]
        weight = vocabulary.scores[piece]
        self.first = np.searchsorted(target, np.arange(total))
        count = np.diff(np.append(self.first, len(target)))
        # Forward filtering: places by their distance from the start of the word.
        reach = np.full(total, -np.inf)
        reach[self.node] = 0.0
        depth = _within(sizes + 1)
        by_depth = np.argsort(depth, kind="stable")
        levels = np.searchsorted(depth[by_depth], np.arange(1, int(sizes.max()) + 2))
        for lo, hi in zip(levels.tolist(), levels[1:].tolist()):
            places = by_depth[lo:hi]
            top = np.full(len(places), -np.inf)
            here, n = self.first[places], count[places]
            most = int(n.max()) if len(n) else 0
            for k in range(most):
                some = np.flatnonzero(n > k)
                edge = here[some] + k
                top[some] = np.logaddexp(top[some], reach[source[edge]] + weight[edge])
            reach[places] = top
        odds = np.exp(reach[source] + weight - reach[target])
        sums_ = np.cumsum(odds)
        before = np.concatenate(([0.0], sums_))[self.first]
        self.share = sums_ - before[target]
        self.last = self.first + count - 1
        self.length, self.piece = length, piece

    def draw(self, nodes: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """For each place an edge into it, by its share of the chance in [0, 1)."""
        edge, last = self.first[nodes], self.last[nodes]
        going = np.flatnonzero((self.share[edge] <= chance) & (edge < last))
        while len(going):
            edge[going] += 1
            on = (self.share[edge[going]] <= chance[going]) & (edge[going] < last[going])
            going = going[on]
        return edge


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of consecutive groups."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _stretches(text: str) -> Iterator[tuple[int, str]]:
    """A text, led by a space, in stretches that begin where no piece goes on, with places."""
    text, at = " " + text, 0
    while len(text) - at > STRETCH:
        end = at + STRETCH
        while end < len(text) and not (text[end] == "\n" or text[end] == " " != text[end - 1]):
            end += 1
        yield at, text[at:end]
        at = end
    if at < len(text):
        yield at, text[at:]


def sample_ids(vocabulary: Vocabulary, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """Ids of one sampled segmentation of each text; an empty text has none."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    rows: list[int] = []
    held: list[tuple[int, str]] = []
    size = 0

    def flush() -> None:
        offsets = np.array([at for at, _ in held], np.int64)
        for row, ids in zip(rows, _sample(vocabulary, [s for _, s in held], keys[rows], offsets)):
            found[row].append(ids)

    for row, text in enumerate(texts):
        for stretch in _stretches(text) if text else ():
            rows.append(row)
            held.append(stretch)
            size += len(stretch[1])
            if size >= STRETCH:
                flush()
                rows, held, size = [], [], 0
    if held:
        flush()
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]


def _sample(vocabulary: Vocabulary, texts: list[str], keys: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Ids of stretches that lie at ``offsets`` of the texts with these keys."""
    parts = [_points(t) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    points = np.concatenate(parts).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    literal = points == MARK
    points[points == 32] = MARK
    points[literal] = _LITERAL_MARK
    plain = vocabulary.has_piece[points]
    begins = np.zeros(len(points), bool)
    begins[bounds[:-1][sizes > 0]] = True
    mark = points == MARK
    begins[1:] |= (mark[1:] & ~mark[:-1]) | ~plain[1:] | ~plain[:-1]
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(points))
    worded = plain[starts]
    starts, ends = starts[worded], ends[worded]
    # A byte-encoded character is marked by its place, to be spelled out at the end.
    chosen = np.zeros(len(points), np.int64)
    chosen[~plain] = -1
    if len(starts):
        hashes = span_hashes(prefix_hashes(points), starts, ends)
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        lattice = _Lattice(vocabulary, points, starts[one], ends[one])
        row = np.searchsorted(bounds, starts, "right") - 1
        key, base = keys.astype(np.uint64)[row], (bounds[:-1] - offsets)[row]
        left, at = ends - starts, ends.copy()
        first = lattice.node[which]
        while len(left):
            place = (at - base).astype(np.uint64)
            chance = (mix(key ^ mix(place)) >> np.uint64(11)) * 2.0**-53
            edge = lattice.draw(first + left, chance)
            chosen[at - 1] = lattice.piece[edge] + 1
            step = lattice.length[edge]
            left, at = left - step, at - step
            on = left > 0
            if not on.all():
                left, at, first = left[on], at[on], first[on]
                key, base = key[on], base[on]
    places = np.flatnonzero(chosen)
    ids = chosen[places] - 1
    spelled = np.flatnonzero(ids < 0)
    if len(spelled):
        values = points[places[spelled]]
        values[values == _LITERAL_MARK] = MARK
        coded = [chr(v).encode() for v in values.tolist()]
        repeats = np.ones(len(ids), np.int64)
        repeats[spelled] = [len(c) for c in coded]
        ids, places = np.repeat(ids, repeats), np.repeat(places, repeats)
        ids[ids < 0] = vocabulary.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
    cuts = np.searchsorted(places, bounds)
    return [ids[lo:hi] for lo, hi in zip(cuts.tolist(), cuts[1:].tolist())]


_vocabularies: dict[int, Vocabulary] = {}


def sample_pieces(
    docs: DataFrame,
    model_file: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    seed: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """One row per document: ``keep``, the sampled ids (``with_ids``), their number and
    checksum, and whether they decode to the very text.

    ``key`` seeds the draws: rows with one key and one text have one segmentation. A null
    key is a key as well; null and empty texts have no pieces. A map over the rows; the
    model (well under a MB) is broadcast.
    """
    with open(model_file, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(
        *[F.col(c) for c in keep],
        F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)).alias("_key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    )
    names = list(keep)
    schema = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names]
    schema += ["ids array<int>"] * with_ids
    schema += ["n_pieces bigint", "ids_crc32 bigint", "lossless boolean"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        check = zlib.crc32(model)
        if check not in _vocabularies:
            _vocabularies[check] = Vocabulary(model)
        vocabulary = _vocabularies[check]
        for batch in slices(batches, "_text", 1 << 20):
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            texts = column("_text").to_pylist()
            keys = np.asarray(column("_key").to_numpy(zero_copy_only=False)).view(np.uint64)
            coded = sample_ids(vocabulary, texts, keys)
            arrays = [column(c) for c in names]
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in coded]))).astype(np.int32)
                values = np.concatenate(coded).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            arrays.append(pa.array([len(x) for x in coded], pa.int64()))
            sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in coded]
            arrays.append(pa.array(sums, pa.int64()))
            same = [vocabulary.decode(x) == t.encode() for x, t in zip(coded, texts)]
            arrays.append(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                arrays, names + ["ids"] * with_ids + ["n_pieces", "ids_crc32", "lossless"]
            )

    return map_batches(rows, encode, ", ".join(schema))


def decode_pieces(
    coded: DataFrame, model_file: str, *, ids: str = "ids", text: str = "text"
) -> DataFrame:
    """The rows with the text that their ids spell; null ids give a null text."""
    with open(model_file, "rb") as file:
        held = coded.sparkSession.sparkContext.broadcast(file.read())
    others = [c for c in coded.columns if c not in (ids, text)]
    rows = coded.select(*[F.col(f"`{c}`") for c in others], F.col(ids).alias("_ids"))
    schema = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(held.value)
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            texts = [
                None if x is None else vocabulary.decode(np.array(x, np.int64)).decode()
                for x in column("_ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [column(c) for c in others] + [pa.array(texts, pa.string())], others + [text]
            )

    return map_batches(rows, decode, ", ".join(schema + [f"`{text}` string"]))
