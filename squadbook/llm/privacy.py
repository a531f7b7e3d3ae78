"""Personal data in texts: rules for four kinds, and spans that a trained tagger adds.

The rules give emails, IP addresses, card and phone numbers. The tagger (``tagger.Tagger``)
is trained on a bounded sample of labelled spans, among them rewritten ones (spaced out,
spelled ``(@)``, grouped otherwise) that no rule matches, and on secrets: values that stand
behind the name of a key or token in the sample, wherever they stand later. A text is cut into overlapping
windows; the spans decoded in all of them are reconciled over the whole text by taking the
non-overlapping set with the highest sum of scores. Spans of the tagger that meet one of
the rules' are left out, so the rules' spans always stand.

Every kind's span holds a digit or ``@``, also a rewritten one; windows without either
cannot give a span and are not decoded. Null and empty texts have no spans, very long ones are
cut into windows like any, and repeated rows give a row each.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadbook.llm.tagger import Tagger, encode
from squadbook.llm.tasks import map_batches, slices

KINDS = ("email", "ip", "card", "phone")
# What the tagger looks for besides other spellings of these: values of keys and tokens.
SECRET = "secret"
TAGGED = (*KINDS, SECRET)
WINDOW = 96
STRIDE = 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive where a longer run never helps: the time is linear in the text.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
# Where the training sample is labelled: a value behind the name of a secret.
_SECRET_NAME = r"(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key)[\"']?[ ]?[:=][ ]?"
_SECRET = re.compile(_SECRET_NAME + r"[\"']?([A-Za-z0-9_+/=.-]{16,44})(?![A-Za-z0-9_+/=.-])")
_NAME_BEFORE = re.compile(r"[A-Za-z_]*" + _SECRET_NAME + r"[\"']?$")
_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def emails(text: str) -> Iterator[Span]:
    """Around each ``@`` in order, the longest local part not yet used and the domain."""
    used = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > used and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            used = domain.end()
            yield Span("email", start, used)
        else:
            used = at + 1
        at = text.find("@", max(used, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def rule_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping spans of each kind, kinds in order."""
    found = list(emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups()):
            found.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(Span("phone", *m.span()))
    return found


def _joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (TAGGED.index(s.kind), s.start, s.end))
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in ordered)


def rewritten(value: str, kind: str, rng: np.random.Generator) -> str:
    """Another spelling of a value of a kind: new digits and letters, other separators."""
    digits, letters = _DIGITS, _LETTERS
    if kind == SECRET:
        # As long as some keys are, of hex digits or of any letters and digits.
        signs = (digits + letters[:6], digits + letters, digits + letters + letters.upper() + "_-")
        chosen = list(signs[int(rng.integers(0, 3))])
        return "".join(rng.choice(chosen, int(rng.integers(20, 45))))
    at = value.find("@") if kind == "email" else len(value)
    fresh = [
        str(rng.choice(list(digits if c in digits else letters))) if c in digits + letters else c
        for c in value[:at]
    ]
    value = "".join(fresh) + value[at:]
    way = int(rng.integers(0, 3))
    if kind == "email":
        return value if way == 0 else value.replace("@", " @ " if way == 1 else "(@)")
    if kind == "ip":
        return value if way == 0 else value.replace(".", " . " if way == 1 else "[.]")
    if kind == "card":
        digits = _NOT_DIGIT.sub("", value)
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return digits if way == 0 else (" " if way == 1 else ".").join(groups)
    return value if way == 0 else value.replace("-", " " if way == 1 else "/")


def labelled_spans(text: str) -> list[Span]:
    """The rules' spans, and values behind the name of a secret, as a sample is labelled."""
    spans = rule_spans(text)
    secrets = [Span(SECRET, *m.span(1)) for m in _SECRET.finditer(text)]
    mixed = [s for s in secrets if _mixed(text[s.start : s.end])]
    return spans + [s for s in mixed if not any(r.start < s.end and r.end > s.start for r in spans)]


def _mixed(value: str) -> bool:
    """Both letters and digits, and no white space."""
    return bool(re.search("[0-9]", value) and re.search("[A-Za-z]", value)) and not re.search(r"\s", value)


def training_windows(texts: list[str], windows: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows of symbols and labels: around labelled spans, around other digits, and plain."""
    rng = np.random.default_rng(seed)
    pieces: list[tuple[str, list[tuple[int, int, int]]]] = []
    for text in texts:
        spans = sorted(labelled_spans(text), key=lambda s: s.start)
        taken = [s for i, s in enumerate(spans) if not i or s.start >= max(x.end for x in spans[:i])]
        for s in taken[:6]:
            value = text[s.start : s.end]
            if len(value) > WINDOW // 2:
                continue
            if rng.random() < 0.5:
                value = rewritten(value, s.kind, rng)
            before = int(rng.integers(0, WINDOW - len(value) + 1)) if len(value) < WINDOW else 0
            left, right = text[max(0, s.start - before) : s.start], text[s.end : s.end + WINDOW]
            if any(x is not s and x.start < s.end + WINDOW and x.end > s.start - before for x in spans):
                left, right = " " * bool(left), " " * bool(right)
            k = 1 + 2 * TAGGED.index(s.kind)
            pieces.append((left + value + right, [(len(left), len(left) + len(value), k)]))
            if s.kind == SECRET:
                # Once more without its name, so that the value itself is learned.
                left, value = _NAME_BEFORE.sub("", left) + '"', rewritten(value, SECRET, rng)
                pieces.append((left + value + right, [(len(left), len(left) + len(value), k)]))
        digits = [m.start() for m in re.finditer(r"[0-9@]+", text)]
        for at in [d for d in digits if not any(s.start - 1 <= d < s.end for s in spans)][:3]:
            lo = max(0, at - WINDOW // 2)
            if not any(s.start < lo + WINDOW and s.end > lo for s in spans):
                pieces.append((text[lo : lo + WINDOW], []))
        lo = int(rng.integers(0, max(1, len(text) - WINDOW)))
        if not any(s.start < lo + WINDOW and s.end > lo for s in spans):
            pieces.append((text[lo : lo + WINDOW], []))
    chosen = rng.permutation(len(pieces))[:windows]
    x = np.zeros((len(chosen), WINDOW), np.int64)
    y = np.zeros((len(chosen), WINDOW), np.int64)
    for row, i in enumerate(chosen.tolist()):
        piece, spans = pieces[i]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)[:WINDOW]
        x[row, : len(points)] = encode(points)
        for lo, hi, k in spans:
            y[row, lo:hi] = k + 1
            if lo < WINDOW:
                y[row, lo] = k
    return x, y


class Finder:
    """A trained tagger and how its windows become spans of a text."""

    def __init__(self, tagger: Tagger | None, margin: float):
        self.tagger, self.margin = tagger, margin

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of the windows that hold a digit or ``@``, with their text and start."""
        rows, owners, starts = [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            marked = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64))
            if not len(marked):
                continue
            last = marked // STRIDE * STRIDE
            places = np.unique(np.concatenate([last, np.maximum(last - STRIDE, 0)]))
            symbols = np.zeros(len(points) + WINDOW, np.int64)
            symbols[: len(points)] = encode(points)
            rows.append(symbols[places[:, None] + np.arange(WINDOW)])
            owners.append(np.full(len(places), i))
            starts.append(places)
        if not rows:
            return np.zeros((0, WINDOW), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(owners), np.concatenate(starts)

    def added(self, texts: list[str], ruled: list[list[Span]]) -> list[list[Span]]:
        """Per text the reconciled spans of the tagger, apart from the rules' spans."""
        found: list[dict[tuple[int, int, int], float]] = [{} for _ in texts]
        if self.tagger is None:
            return [[] for _ in texts]
        x, owners, starts = self.windows(texts)
        for at in range(0, len(x), 2048):
            labels, margins = self.tagger.decode(x[at : at + 2048])
            begin = (labels % 2 == 1) & (labels > 0)
            for row, lo in zip(*np.nonzero(begin)):
                label, hi = labels[row, lo], lo + 1
                while hi < WINDOW and labels[row, hi] == label + 1:
                    hi += 1
                text = texts[owners[at + row]]
                first = int(starts[at + row])
                start, end = first + int(lo), min(first + int(hi), len(text))
                mean = float(margins[row, lo : hi + 1].sum()) / int(hi - lo)
                # A span at the border of a window may be a part; another window holds it whole.
                cut = (lo == 0 and first > 0) or (hi == WINDOW and end < len(text))
                if mean < self.margin or cut:
                    continue
                key = (start, end, int(label) // 2)
                spans = found[owners[at + row]]
                spans[key] = max(spans.get(key, 0.0), mean * (end - start))
        return [
            self._reconciled(text, spans, rules)
            for text, spans, rules in zip(texts, found, ruled)
        ]

    @staticmethod
    def _reconciled(text: str, spans: dict, rules: list[Span]) -> list[Span]:
        """The non-overlapping spans of the highest total score, away from the rules' spans."""
        fits = []
        for (start, end, kind), score in spans.items():
            if any(r.start < end and r.end > start for r in rules):
                continue
            value = text[start:end]
            digits = len(_NOT_DIGIT.sub("", value))
            secret = len(value) >= 16 and _mixed(value)
            enough = ("@" in value, 4 <= digits <= 12, 12 <= digits <= 19, 8 <= digits <= 15, secret)
            if enough[kind]:
                fits.append((end, start, kind, score))
        fits.sort()
        ends = [f[0] for f in fits]
        best: list[tuple[float, int]] = [(0.0, -1)]
        for i, (_, start, _, score) in enumerate(fits):
            with_it = best[bisect.bisect_right(ends, start, 0, i)][0] + score
            best.append(max((best[i][0], -1), (with_it, i), key=lambda b: b[0]))
        chosen, at = [], len(fits)
        while at:
            if best[at][1] < 0:
                at -= 1
                continue
            end, start, kind, _ = fits[best[at][1]]
            chosen.append(Span(TAGGED[kind], start, end))
            at = bisect.bisect_right(ends, start, 0, best[at][1])
        return chosen


def trained_finder(
    docs: DataFrame, *, text: str = "text", documents: int = 600, windows: int = 900, margin: float = 0.5
) -> Finder:
    """A finder fitted on at most ``documents`` texts that hold numbers, ``@`` or names of secrets.

    The first texts by a hash are taken, at most 4,000 characters of each from its middle:
    a bounded sample for fitting; what is searched later are the whole texts. A count tells below
    what hash the first ones are, so no more than a few times as many rows are sorted.
    """
    likely = r"@[A-Za-z0-9-]+\.|[0-9][0-9. ()-]{5,}[0-9]|" + _SECRET_NAME
    body = F.col(text).cast("string")
    middle = F.greatest(F.lit(1), ((F.length(body) - 4000) / 2).cast("int"))
    key = F.xxhash64(body)
    rows = docs.where(body.rlike(likely)).count()
    below = int((1 << 64) * min(1.0, 4 * documents / max(rows, 1))) - (1 << 63) - 1
    sample = (
        # The hash is looked at first: most texts are not searched again.
        docs.where(F.when(key <= below, body.rlike(likely)).otherwise(F.lit(False)))
        .select(key.alias("key"), F.substring(body, middle, F.lit(4000)).alias("part"))
        .distinct()
        .orderBy("key", "part")
        .limit(documents)
    )
    x, y = training_windows([r["part"] for r in sample.collect()], windows)
    if not (y > 0).any():
        return Finder(None, margin)
    tagger = Tagger(len(TAGGED))
    tagger.train(x, y)
    return Finder(tagger, margin)


RESULT = [f"n_{kind}" for kind in KINDS] + ["base_sha256", "spans", "n_added", "n_spans"]


def find_personal_data(
    docs: DataFrame,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    finder: Finder | None = None,
) -> DataFrame:
    """One row per document: ``keep``, counts and digest of the rules' spans, and all spans.

    ``n_added`` counts the tagger's spans, ``n_spans`` all of them.

    A map over the rows with the tagger's weights (a few thousand numbers) at hand.
    """
    finder = trained_finder(docs, text=text) if finder is None else finder
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_text"))
    schema = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    schema += [f"n_{kind} bigint" for kind in KINDS]
    schema += ["base_sha256 string", "spans string", "n_added bigint", "n_spans bigint"]
    names = list(keep)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 2 << 20):
            column = lambda c: batch.column(batch.schema.get_field_index(c))
            texts = [t or "" for t in column("_text").to_pylist()]
            ruled = [rule_spans(t) for t in texts]
            added = finder.added(texts, ruled)
            counts = [[sum(s.kind == kind for s in spans) for spans in ruled] for kind in KINDS]
            digests = [hashlib.sha256(_joined(spans).encode()).hexdigest() for spans in ruled]
            arrays = [column(c) for c in names]
            arrays += [pa.array(c, pa.int64()) for c in counts]
            arrays.append(pa.array(digests, pa.string()))
            arrays.append(pa.array([_joined(a + b) for a, b in zip(ruled, added)], pa.string()))
            arrays.append(pa.array([len(b) for b in added], pa.int64()))
            arrays.append(pa.array([len(a) + len(b) for a, b in zip(ruled, added)], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names + RESULT)

    return map_batches(rows, find, ", ".join(schema))
