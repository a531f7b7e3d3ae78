import random
import re

import numpy as np

from squadbook.llm import overlap, similarity
from squadbook.llm.overlap import candidate_links, similar_links, sketch
from squadbook.llm.similarity import one_of_each, similar_documents
from tests.llm.conftest import frame, prose


def roots(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    first = {}
    return [first.setdefault(find(i), i) for i in range(n)]


def shingles(text, width=5):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def expected(rows):
    sets = [shingles(r[1]) for r in rows]
    edges = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    root = roots(len(rows), edges)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def families(seed, n=40):
    rng = random.Random(seed)
    texts = []
    for f in range(6):
        base = prose(seed * 100 + f, rng.choice([3, 12, 60, 200])).split(" ")
        for _ in range(n // 6):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(words))
    passage = prose(seed + 7, 40)
    texts += [prose(seed * 50 + i, 120) + " " + passage for i in range(12)]
    rng.shuffle(texts)
    return [(100 + i, t) for i, t in enumerate(texts)]


def test_searches_against_brute_force():
    rng = np.random.default_rng(1)

    def members(n):
        return rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)

    for heap in (0, 512):
        overlap.HEAP_MEMBERS = heap
        for _ in range(120):
            base = [members(rng.integers(1, 80)) for _ in range(3)]
            sets = []
            for _ in range(rng.integers(2, 25)):
                b = base[rng.integers(0, 3)]
                some = b[rng.integers(0, len(b) // 4 + 1) :]
                sets.append(np.unique(np.concatenate([some, members(rng.integers(0, len(b) // 5 + 1))])))
            true = [
                (i, j)
                for i in range(len(sets))
                for j in range(i)
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
            ]
            found = similar_links(sets, 80)
            assert {(max(e), min(e)) for e in found} <= set(true)
            assert roots(len(sets), found) == roots(len(sets), true)
            allowed = candidate_links(np.array([len(s) for s in sets]), [sketch(s) for s in sets], 80)
            root = roots(len(sets), allowed)
            assert all(root[a] == root[b] for a, b in true)
    overlap.HEAP_MEMBERS = 512


def test_against_brute_force(spark):
    rows = families(1)
    assert result(similar_documents(frame(spark, rows))) == expected(rows)


def test_sliced_groups_and_frequent_members(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SLICE_CLASSES", 4)
    monkeypatch.setattr(similarity, "SLICE_MEMBERS", 300)
    monkeypatch.setattr(similarity, "MIN_FREQUENT", 4)
    rows = families(2)
    assert result(similar_documents(frame(spark, rows).coalesce(1))) == expected(rows)


def test_awkward_rows(spark, awkward, empty):
    df, rows = awkward
    assert result(similar_documents(df)) == expected(rows)
    assert similar_documents(empty).collect() == []


def test_one_of_each(spark, awkward):
    df, rows = awkward
    kept = one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # Of the four rows with id 6 or none, two texts; rows without words all stay.
    assert ids == sorted([1, 2, 3, 4, 5, 6, 6, 7, 8, None], key=str)


def test_one_of_each_holds_texts_packed_and_few_shuffles(spark, monkeypatch):
    labels, stored = [], similarity.stored

    def noted(df, label, compression=None):
        labels.append((label, compression))
        return stored(df, label, compression)

    monkeypatch.setattr(similarity, "stored", noted)
    monkeypatch.setattr(similarity, "forget_shuffles", lambda spark: labels.append("forget"))
    text = prose(5, 60)
    kept = one_of_each(frame(spark, [(1, text), (2, text), (3, prose(6, 60))])).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]
    assert labels[0] == ("documents", "zstd")
    assert all(labels[labels.index((x, None)) + 1] == "forget" for x in ("candidates", "links"))
