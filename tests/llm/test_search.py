import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from squadbook.llm import search
from squadbook.llm.search import Best, ranked_documents, search_block
from tests.llm.conftest import frame, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def by_hand(docs, items, k=10):
    texts = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in texts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in texts for t in c)
    rows = []
    for item_id, text in items:
        scored = []
        for (doc_id, counts), size in zip(texts, sizes):
            score = 0
            for t in set(terms(text)) & set(counts):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 10 + (90 * size * n) // total
                score += w * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            rows.append((item_id, rank, doc_id, -score))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, score string")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    common = [f"c{i}" for i in range(12)]
    rare = [f"r{i}" for i in range(300)]
    docs = []
    for i in range(600):
        n = rng.choice([3, 10, 40, 200])
        docs.append((i, " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(n))))
    copy = "r1 r2 c3 shared copy of a text"
    docs += [(1000 - i, copy) for i in range(60)]
    items = [(j, " ".join(rng.choices(common, k=4) + rng.choices(rare, k=rng.choice([0, 2, 9])))) for j in range(20)]
    return docs, items + [(50, copy), (51, "C0, c1! C2"), (52, "nowhere"), (53, None), (54, "")]


@pytest.mark.parametrize("block", [64, 4096])
def test_equals_scoring_every_document(spark, corpus, monkeypatch, block):
    docs, items = corpus
    monkeypatch.setattr(search, "BLOCK_DOCS", block)
    answer = ranked_documents(frame(spark, docs).repartition(3), items_frame(spark, items))
    assert got(answer) == by_hand(docs, items)


def test_slices_of_items_give_the_same(spark, corpus):
    docs, items = corpus
    answer = ranked_documents(frame(spark, docs), items_frame(spark, items), slice_terms=30)
    assert got(answer) == by_hand(docs, items)


def test_odd_input(spark, awkward):
    df, rows = awkward
    items = [(1, rows[4][1][:200]), (1, rows[5][1]), (None, "été un 7"), (3, prose(5, 4)), (3, "\x00 --")]
    docs = [(r[0], r[1]) for r in rows]
    assert got(ranked_documents(df, items_frame(spark, items))) == by_hand(docs, items)


def test_empty_tables(spark, empty):
    items = items_frame(spark, [(1, "a word")])
    assert got(ranked_documents(empty, items)) == []
    assert got(ranked_documents(frame(spark, [(1, "a word")]), items.limit(0))) == []


def test_ids_have_to_be_integers(spark):
    docs = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    with pytest.raises(TypeError, match="doc_id"):
        ranked_documents(docs, docs, item_id="doc_id")


@pytest.mark.parametrize("seed", range(30))
def test_a_block_is_searched_like_by_hand(seed):
    rng = np.random.default_rng(seed)
    n = 3000
    ids = np.sort(rng.choice(10**6, n, replace=seed % 2 == 0))
    lists, scores = [], np.zeros(n, np.int64)
    for size in rng.choice([1, 5, 30, 300, 2500], 12):
        docs = np.sort(rng.choice(n, size, replace=False))
        adds = rng.integers(1, rng.choice([3, 50, 1000]), size)
        scores[docs] += adds
        lists.append((docs, adds, int(adds.max())))
    best = Best(10)
    best.offer(np.array([40, 7]), np.array([5, 3]), np.zeros(2, bool))
    search_block(lists, ids, np.zeros(n, bool), best, short=int(rng.choice([0, 40, 10**6])))
    all_scores = np.concatenate((scores, [40, 7]))
    all_ids = np.concatenate((ids, [5, 3]))
    held = np.flatnonzero(all_scores)
    order = held[np.lexsort((all_ids[held], -all_scores[held]))][:10]
    assert best.scores.tolist() == all_scores[order].tolist()
    assert best.ids.tolist() == all_ids[order].tolist()
