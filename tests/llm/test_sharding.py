import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from squadbook.llm import sharding
from squadbook.llm.sharding import kd_shards
from tests.llm.conftest import frame, prose

CELLS = (1 << 20) - 1


def size_of(text):
    return len((text or "").encode()) + 16


def md5_bits(text, bits):
    digits = -(-bits // 4)
    return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16) >> (4 * digits - bits)


def by_hand(rows, shards):
    """Shards by sorting every node; ids are distinct. Rows: id, text, lang, source, n_chars."""

    def scaled(column):
        values = [float(r[column]) for r in rows if r[column] is not None]
        low, high = min(values), max(values)
        return [
            0 if r[column] is None or high == low else int((r[column] - low) / (high - low) * CELLS)
            for r in rows
        ]

    def named(column):
        return [0 if r[column] is None else md5_bits(r[column], 20) for r in rows]

    x = [named(3), named(2), scaled(4), scaled(0)]
    tie = [md5_bits("" if r[0] is None else str(r[0]), 27) for r in rows]
    size = [size_of(r[1]) for r in rows]
    shard = {}

    def cut(held, first, n):
        if n == 1 or not held:
            shard.update((i, first) for i in held)
            return
        width = [max(d[i] for i in held) - min(d[i] for i in held) for d in x]
        along = x[width.index(max(width))]
        held = sorted(held, key=lambda i: (along[i], tie[i]))
        total, before, left = sum(size[i] for i in held), 0, n // 2
        for at, i in enumerate(held):
            if (before + size[i]) * n >= total * left:
                break
            before += size[i]
        if (2 * before + size[i]) * n <= 2 * total * left:
            at += 1
        cut(held[:at], first, left)
        cut(held[at:], first + left, n - left)

    cut(range(len(rows)), 0, shards)
    return {rows[i][0]: s for i, s in shard.items()}


def checked(df, rows, shards):
    got = df.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], size_of(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows
    )
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(9)}"
        lang = rng.choice(["en", "fr", None])
        text = prose(i % 40, rng.choice([1, 5, 30, 90]))
        rows.append((i * 7 - 500, text, lang, source, rng.choice([len(text), None])))
    return rows


@pytest.mark.parametrize("shards", [2, 7, 40])
def test_equals_sorting_every_node(spark, corpus, shards):
    got = checked(kd_shards(frame(spark, corpus).repartition(3), shards=shards), corpus, shards)
    assert {r.doc_id: r.shard for r in got} == by_hand(corpus, shards)
    bytes_ = Counter()
    for r in got:
        bytes_[r.shard] += r.size
    assert max(bytes_.values()) < 1.2 * min(bytes_.values())


def test_target_bytes(spark, corpus):
    total = sum(size_of(r[1]) for r in corpus)
    got = checked(kd_shards(frame(spark, corpus), target_bytes=total // 10), corpus, 11)
    assert len({r.shard for r in got}) == 11
    with pytest.raises(ValueError):
        kd_shards(frame(spark, corpus))


def test_slots_of_many_groups(spark, corpus, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    one = checked(kd_shards(frame(spark, corpus), shards=3), corpus, 3)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 10**6)
    assert sorted(one) == sorted(checked(kd_shards(frame(spark, corpus), shards=3), corpus, 3))


def test_rows_of_one_id_are_spread(spark):
    rows = [(None, "the same text", "en", "a", 13)] * 3000
    got = checked(kd_shards(frame(spark, rows), shards=8), rows, 8)
    counts = Counter(r.shard for r in got)
    assert len(counts) == 8 and max(counts.values()) <= min(counts.values()) + 8


def test_odd_input(spark, awkward):
    df, rows = awkward
    checked(kd_shards(df, shards=4), rows, 4)
    # More shards than documents; columns without a finite number.
    odd = df.withColumn("n_chars", df.doc_id * float("nan"))
    checked(kd_shards(odd, shards=40), rows, 40)
    checked(kd_shards(df, shards=1), rows, 1)


def test_empty_table(empty):
    assert kd_shards(empty, shards=40).collect() == []
    assert kd_shards(empty, target_bytes=10).collect() == []
