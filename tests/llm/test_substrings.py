import collections
import hashlib
import random

import numpy as np
import pytest

from squadbook.llm import substrings
from squadbook.llm.arrays import text_bytes
from squadbook.llm.substrings import dedup_substrings, least_in_windows, pieces_of
from squadbook.llm.suffixes import common_prefixes, repeated_starts, two_stage
from tests.llm.conftest import frame, prose


def removed(texts, length):
    """By brute force: bytes, removed bytes, runs and digest of what is left."""
    bodies = [(t or "").encode() for t in texts]
    counts = collections.Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                covered[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        out.append((len(b), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    rows = df.collect()
    return sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def expected(rows, length=400):
    found = removed([r[1] for r in rows], length)
    return sorted((r[0] or -1, *f) for r, f in zip(rows, found))


def test_two_stage_order():
    rng = random.Random(2)
    for _ in range(200):
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 60)))
        depth = rng.randint(1, 9)
        order = two_stage(text, depth).tolist()
        assert sorted(order) == list(range(len(text)))
        keys = [text[p : p + depth] for p in order]
        assert keys == sorted(keys)


def test_common_prefixes():
    text = b"banana bananas"
    order = two_stage(text, 20)
    common = common_prefixes(text, order, 20)
    for a, b, c in zip(order[:-1], order[1:], common):
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        assert c == k


def test_repeated_starts_stay_in_their_piece():
    assert [x.tolist() for x in repeated_starts([b"abab", b"xab", b"ba"], 2)] == [[0, 1, 2], [1], [0]]


def test_least_in_windows():
    values = np.random.default_rng(1).integers(0, 50, 500).astype(np.uint64)
    for width in (1, 2, 3, 7, 64, 301):
        assert least_in_windows(values, width).tolist() == [
            min(values[i : i + width].tolist()) for i in range(500 - width + 1)
        ]


def test_pieces_cover_every_string_once(monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 700)
    import pyarrow as pa

    texts = ["", "a" * 900, prose(1, 300), "short", prose(2, 200), "b" * 400, "c" * 399]
    data, offsets = text_bytes(pa.array(texts))
    seen = collections.Counter()
    for found in pieces_of(data, offsets, 400):
        for row, start, n, place in zip(found["row"], found["start"], found["n"], found["place"]):
            assert 0 <= place <= 300 + n
            seen.update((int(row), int(start) + k) for k in range(n))
    assert seen == {(r, p): 1 for r, t in enumerate(texts) for p in range(len(t.encode()) - 399)}


def test_removes_repeats(spark):
    passage, other = prose(7, 100), prose(8, 150)
    rows = [
        (1, prose(1, 50) + passage + prose(2, 50)),
        (2, passage),
        (3, other + " " + other),
        (4, prose(3, 300)),
        (5, passage[:395]),
        (6, "é" * 700),
        (7, prose(4, 300) + "x"),
        (8, "y" + prose(4, 300)),
    ]
    got = result(dedup_substrings(frame(spark, rows)))
    assert got == expected(rows)
    assert [r[2] > 0 for r in got] == [True, True, True, False, False, True, True, True]


def test_large_groups_are_cut_finer(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SORT_BYTES", 2000)
    passages = {n: prose(n, 200)[:n] for n in (150, 390, 420)}
    rows = [(i, prose(100 + i, 60) + passages[(150, 390, 420)[i % 3]] + prose(200 + i, 60)) for i in range(36)]
    assert result(dedup_substrings(frame(spark, rows))) == expected(rows)


def test_awkward_rows(spark, awkward):
    df, rows = awkward
    assert result(dedup_substrings(df)) == expected(rows)


def test_text_and_empty_table(spark, empty):
    assert dedup_substrings(empty).collect() == []
    row = dedup_substrings(frame(spark, [(1, "a" * 401)]), with_text=True).first()
    assert (row.kept, row.n_removed) == (b"", 401)
    assert dedup_substrings(frame(spark, [(1, "a" * 400)]), with_text=True).first().kept == b"a" * 400


@pytest.mark.parametrize("length", [150])
def test_other_lengths(spark, length):
    rows = [(1, prose(1, 60)), (2, prose(1, 60)[30:] + prose(2, 40)), (3, prose(3, 60))]
    assert result(dedup_substrings(frame(spark, rows), length=length)) == expected(rows, length)
