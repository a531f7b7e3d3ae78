import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from squadbook.llm import spelling
from squadbook.llm.spelling import followed, packed, spelling_variants
from tests.llm.conftest import frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def counted(rows, spoil_every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % spoil_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, spoil_every=199):
    n = counted(rows, spoil_every)
    near = defaultdict(list)
    words = sorted(n)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in words}


def got(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def variants(rng, word):
    letters = "abcdeéÀ×"
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return word[:at] + rng.choice(letters) + word[at:]
    at = min(at, len(word) - 1)
    return word[:at] + ("" if kind == 1 else rng.choice(letters)) + word[at + 1 :]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = []
    words = ["".join(rng.choices("abcdeé", k=rng.randint(5, 9))) for _ in range(60)]
    words += ["abcdef" * 40, "aaaaaaaa", "aaaaaaa", "éééééé", "ÉÉÉÉÉÉ", "Théâtres"]
    for i in range(150):
        text = []
        for _ in range(60):
            word = rng.choice(words[: rng.choice([5, 66])])
            while rng.random() < 0.35:
                word = variants(rng, word)
            text.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", ", ", "1", "\n"]).join(text)))
    return rows


@pytest.mark.parametrize("tile", [spelling.TILE, 8])
@pytest.mark.parametrize("spoil", [199, 3])
def test_equals_comparing_all_words(spark, corpus, tile, spoil):
    answer = spelling_variants(frame(spark, corpus), spoil_every=spoil, tile=tile)
    wanted = by_hand(corpus, spoil)
    assert len(wanted) > 100 and any(w[4] > 3 for w in wanted)
    assert got(answer) == wanted


def test_roots_follow_several_forms(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    text = " ".join(" ".join([w] * (5 * 5**k)) for k, w in enumerate(words))
    answer = {r.word: (r.form, r.root) for r in spelling_variants(frame(spark, [(1, text)])).collect()}
    assert answer["aaaaaa"] == ("aaaaab", "aabbbb")
    assert answer["aabbbb"] == (None, "aabbbb")


def test_long_chains_are_followed_to_the_end(spark):
    forms = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}") for i in range(40)], "word string, form string")
    assert {r.root for r in followed(forms).collect()} == {"w40"}


def test_equal_counts_go_by_code_point(spark):
    text = " ".join(["abcdef"] * 5 + ["abcdeé"] * 25 + ["abcdez"] * 25)
    answer = {r.word: r for r in spelling_variants(frame(spark, [(1, text)])).collect()}
    assert (answer["abcdef"].form, answer["abcdef"].n_near) == ("abcdez", 2)


def test_odd_input(spark, awkward):
    df, rows = awkward
    long = "x" * 30_000
    more = [(None, f"{long} {long}y " * 5), (31, "unmarked " * 9 + "unmarkéd\n" * 50)]
    every = [(r[0], r[1]) for r in rows] + more
    assert got(spelling_variants(df.unionByName(frame(spark, more)), spoil_every=199)) == by_hand(every)


def test_empty_table(empty):
    assert spelling_variants(empty, spoil_every=199).collect() == []


def test_blocks_are_kept_whole():
    units = sorted([1] * 7 + [2] + [3] * 2 + [5] * 30 + [6, 7, 8])
    batches = [
        pa.RecordBatch.from_arrays([pa.array(units[i : i + 4], pa.int64())], ["unit"])
        for i in range(0, len(units), 4)
    ]
    packs = [t.column("unit").to_pylist() for t in packed(iter(batches), 5)]
    assert sum(packs, []) == units
    assert all(set(a).isdisjoint(b) for a, b in zip(packs, packs[1:]))
    # What precedes the last block of a pack is less than the limit.
    assert all(len(p) - p.count(p[-1]) < 5 for p in packs)
