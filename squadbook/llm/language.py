"""Language identification by cross-parsing entropy.

A suffix automaton per language holds a bounded sample of its labelled text. A text is cut
into the longest phrases that occur in the sample (cross-parsing); the fewer phrases a
character it takes, the closer the language. Automata become transition tables, and many
stretches of text are parsed side by side, a character at a time.

Letters only count: A text is lower-cased, every run of other characters is one separator,
and letters that no sample holds cost a phrase each. Texts are parsed in stretches of
``STRETCH`` symbols, for every language alike, and a stretch ends a phrase.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squadbook.llm.tasks import map_batches, slices

STRETCH = 1024
UNDETERMINED = "und"


def is_held_out(doc_id):
    """Rows kept for evaluation: crc32 of the id as text leaves remainder 2 by 4."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point of the basic plane whether it is a letter."""
    if not _letters:
        points = [chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x10000)]
        _letters.append(np.array(points))
    return _letters[0]


def symbols(text: str, alphabet: np.ndarray) -> np.ndarray:
    """A text as symbols: 0 between words, from 1 the alphabet, last the unknown letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    plane = np.minimum(points, 0xFFFF)
    letter = _letter_table()[plane] | (points > 0xFFFF)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of other characters stays as a separator
    place = np.searchsorted(alphabet, points[keep])
    place[place == len(alphabet)] = 0
    known = alphabet[place] == points[keep] if len(alphabet) else np.zeros(len(place), bool)
    coded = np.where(known, place + 1, len(alphabet) + 1)
    return np.where(letter[keep], coded, 0).astype(np.int64)


def suffix_automaton(text: list[int], width: int) -> np.ndarray:
    """Transitions of the automaton of all substrings; state 0 means none, state 1 is the start."""
    following: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in text:
        state = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p and c not in following[p]:
            following[p][c] = state
            p = link[p]
        if not p:
            link[state] = 1
        else:
            q = following[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    table = np.zeros((len(following), width), np.int32)
    for state, steps in enumerate(following):
        for c, target in steps.items():
            table[state, c] = target
    return table


class Model:
    """Languages in order, the joint alphabet, and one transition table per language."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted({c for t in samples.values() for c in t.lower() if c.isalpha()})
        self.alphabet = np.array([ord(c) for c in letters], np.uint32)
        width = len(letters) + 2
        self.tables = [
            suffix_automaton(symbols(samples[x], self.alphabet).tolist(), width)
            for x in self.languages
        ]
        # Where there is no way on, a phrase ends and the next begins with this symbol. The
        # symbols that a sample lacks begin none, so they lead back to the start.
        for table in self.tables:
            table[1][table[1] == 0] = 1

    def phrases(self, stretches: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each stretch (rows, padded) in each language; longest stretches first."""
        counts = np.zeros((len(self.tables), len(stretches)), np.int64)
        columns = np.ascontiguousarray(stretches.T)
        active = np.searchsorted(-lengths, -np.arange(1, len(columns) + 1), "right")
        for k, table in enumerate(self.tables):
            width = table.shape[1]
            flat, start = table.ravel(), table[1]
            state = np.ones(len(stretches), np.int32)
            total = counts[k]
            for symbol, n in zip(columns, active.tolist()):
                if not n:
                    break
                symbol, now = symbol[:n], state[:n]
                ahead = flat[now * width + symbol]
                stuck = np.flatnonzero(ahead == 0)
                if len(stuck):
                    ahead[stuck] = start[symbol[stuck]]
                    total[stuck] += 1
                # A symbol unknown to the sample is a phrase of its own.
                total[:n] += ahead == 1
                state[:n] = ahead
            total += state > 1
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and least cost in bits a symbol of each text."""
        coded = [symbols(t or "", self.alphabet) for t in texts]
        owner, parts = [], []
        for i, x in enumerate(coded):
            if (x > 0).any() and self.languages:
                for at in range(0, len(x), STRETCH):
                    owner.append(i)
                    parts.append(x[at : at + STRETCH])
        phrases = np.zeros((len(self.languages), len(texts)), np.int64)
        lengths = np.array([len(p) for p in parts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        owner = np.array(owner, np.int64)
        for at in range(0, len(order), 4096):
            chosen = order[at : at + 4096]
            block = np.zeros((len(chosen), int(lengths[chosen[0]])), np.int64)
            for row, part in enumerate(chosen.tolist()):
                block[row, : lengths[part]] = parts[part]
            counts = self.phrases(block, lengths[chosen])
            for k in range(len(self.languages)):
                np.add.at(phrases[k], owner[chosen], counts[k])
        sizes = np.array([len(x) for x in coded], np.int64)
        known = np.zeros(len(texts), bool)
        known[owner] = True
        # Bits a symbol: phrases times the log of the sample's length.
        weights = np.array([np.log2(max(t.shape[0], 2)) for t in self.tables])
        cost = phrases * weights[:, None] / np.maximum(sizes, 1)
        names, scores, bits = [], np.zeros(len(texts)), np.zeros(len(texts))
        for i in range(len(texts)):
            if not known[i]:
                names.append(UNDETERMINED)
                continue
            ranked = np.argsort(cost[:, i], kind="stable")
            names.append(self.languages[ranked[0]])
            bits[i] = cost[ranked[0], i]
            second = cost[ranked[1], i] if len(ranked) > 1 else 2 * cost[ranked[0], i]
            scores[i] = min(1.0, max(0.0, 1 - cost[ranked[0], i] / second)) if second else 0.0
        return names, scores, bits


# Rows that are ranked for each that is wanted, as some are repeats or have no letters.
_SPARE = 8
_PLACES = 1 << 40


def labelled_samples(
    docs: DataFrame, *, doc_id: str, text: str, lang: str, documents: int, characters: int
) -> dict[str, str]:
    """Text per language from rows that are not held out.

    ``documents`` rows a language, the first by a hash of their text, give equal shares of
    ``characters`` characters, taken from the middle of each. The bound is languages times
    characters; the ranks are cut to it in every task before anything is shuffled.
    """
    rows = docs.where(~is_held_out(F.col(doc_id))).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    )
    rows = rows.where(F.col("lang").isNotNull()).withColumn("key", F.xxhash64("text"))
    shares = rows.groupBy("lang").agg(
        F.least(F.lit(1.0), F.lit(_SPARE * documents) / F.count(F.lit(1))).alias("part_of_all")
    )
    place = F.pmod("key", F.lit(_PLACES))
    # A row a language: fewer than the sample, which the driver holds.
    rows = rows.join(F.broadcast(shares), "lang").where(place <= F.col("part_of_all") * _PLACES)
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    share = max(1, characters // documents)
    middle = F.greatest(F.lit(1), ((F.length("text") - share) / 2).cast("int") + 1)
    rows = rows.select(
        "lang", place.alias("key"), F.substring(F.col("text"), middle, F.lit(share)).alias("part")
    )
    first = Window.partitionBy("lang").orderBy("key", "part")
    chosen = (
        rows.distinct()
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= documents)
        .orderBy("lang", "n")
    )
    samples: dict[str, str] = {}
    for row in chosen.collect():
        samples[row["lang"]] = samples.get(row["lang"], "") + row["part"] + "\n"
    return samples


def identify_languages(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    documents: int = 80,
    characters: int = 24_000,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every row with ``held_out, lang_pred, score, bits``, beside the columns ``keep`` (the id).

    The classifier is fitted on at most ``documents`` rows and ``characters`` characters a
    language; predictions read the text alone. ``lang_pred`` is ``und`` and the score 0 for
    a null text, one without letters, and wherever no row is labelled. The score is the
    share by which the best language's cost lies below the second's, 0 where they are equal, and
    then the first by name is given; ``bits`` is that cost a
    symbol, low for text that is much like the sample and high for letters in disorder.
    """
    keep = (doc_id,) if keep is None else keep
    model = Model(
        labelled_samples(
            docs, doc_id=doc_id, text=text, lang=lang, documents=documents, characters=characters
        )
    )
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        *[F.col(c) for c in keep],
        is_held_out(F.col(doc_id)).alias("_held_out"),
        F.col(text).cast("string").alias("_text"),
    )
    names = list(keep)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 2 << 20):
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            found, scores, bits = held.value.predict(column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [column(c) for c in names]
                + [column("_held_out"), pa.array(found, pa.string())]
                + [pa.array(scores), pa.array(bits)],
                names + ["held_out", "lang_pred", "score", "bits"],
            )

    return map_batches(
        rows, predict, schema + ", held_out boolean, lang_pred string, score double, bits double"
    )
