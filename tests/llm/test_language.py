import random
import zlib

import numpy as np
import pytest

from squadbook.llm import language
from squadbook.llm.language import Model, identify_languages, suffix_automaton, symbols
from tests.llm.conftest import frame


def sentence(lang, seed, n=60):
    rng = random.Random(f"{lang}{seed}")
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["shre", "gnol", "warp", "drim"]}[lang]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def test_automaton_has_all_substrings():
    text = [1, 2, 1, 1, 3, 2, 1, 2]
    table = suffix_automaton(text, 5)
    inside = {tuple(text[i:j]) for i in range(8) for j in range(i, 9)}
    rng = random.Random(1)
    for _ in range(500):
        word = [rng.randint(1, 4) for _ in range(rng.randint(0, 5))]
        state = 1
        for c in word:
            state = table[state, c] if state else 0
        assert (state > 0) == (tuple(word) in inside)


def test_phrases_against_greedy_parsing(monkeypatch):
    monkeypatch.setattr(language, "STRETCH", 16)
    model = Model({"aa": sentence("aa", 0), "bb": sentence("bb", 0)})
    texts = [sentence("aa", 1, 9) + " " + sentence("bb", 1, 9), "zzz", "ka", sentence("bb", 2, 30)]
    samples = {x: symbols(sentence(x, 0), model.alphabet).tolist() for x in ("aa", "bb")}

    def phrases(part, sample):
        joined = "".join(map(chr, sample))
        count, at = 0, 0
        while at < len(part):
            end = at + 1
            while end <= len(part) and "".join(map(chr, part[at:end])) in joined:
                end += 1
            at = max(end - 1, at + 1)
            count += 1
        return count

    for text in texts:
        coded = symbols(text, model.alphabet)
        parts = [coded[i : i + 16].tolist() for i in range(0, len(coded), 16)]
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        block = np.zeros((len(parts), int(lengths.max())), np.int64)
        for row, i in enumerate(order):
            block[row, : lengths[i]] = parts[i]
        counts = model.phrases(block, lengths[order]).sum(axis=1)
        assert counts.tolist() == [sum(phrases(p, samples[x]) for p in parts) for x in ("aa", "bb")]


def test_held_out_accuracy(spark):
    rows = [(i, sentence("ab"[i % 2] * 2, i), "ab"[i % 2] * 2, "s", 1) for i in range(200)]
    got = identify_languages(frame(spark, rows)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert any(r.held_out for r in got)
    assert all(r.lang_pred == "ab"[r.doc_id % 2] * 2 and 0 < r.score <= 1 for r in got)


def test_held_out_labels_are_not_learned(spark):
    rows = [(i, sentence("aa", i), "aa") for i in range(60)]
    rows = [r if zlib.crc32(str(r[0]).encode()) % 4 != 2 else (r[0], sentence("bb", r[0]), "bb") for r in rows]
    assert {r.lang_pred for r in identify_languages(frame(spark, rows)).collect()} == {"aa"}


def test_awkward_rows(spark, awkward, empty):
    df, rows = awkward
    got = identify_languages(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert r.lang_pred in ("en", "fr", "und")
    assert identify_languages(empty).collect() == []
    unlabelled = identify_languages(frame(spark, [(1, "some text")])).first()
    assert (unlabelled.lang_pred, unlabelled.score) == ("und", 0.0)


@pytest.mark.parametrize("batch", [1, 3])
def test_prediction_is_of_the_text_alone(batch):
    model = Model({"aa": sentence("aa", 0), "bb": sentence("bb", 0)})
    texts = [sentence("aa", 3), "", None, sentence("bb", 4, 2000), "12 34"]
    whole = model.predict(texts)
    parts = [model.predict(texts[i : i + batch]) for i in range(0, 5, batch)]
    assert [x for p in parts for x in p[0]] == whole[0]
    assert np.concatenate([p[1] for p in parts]).tolist() == whole[1].tolist()
