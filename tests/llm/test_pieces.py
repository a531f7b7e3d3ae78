import collections
import math
import random

import numpy as np
import public_tokenizers
import pytest

from squadbook.llm import pieces
from squadbook.llm.arrays import mix
from squadbook.llm.pieces import MARK, Vocabulary, decode_pieces, sample_ids, sample_pieces
from tests.llm.conftest import frame, prose

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, "rb") as file:
        return Vocabulary(file.read())


def keys(n):
    return mix(np.arange(n, dtype=np.uint64))


def test_lossless(vocabulary):
    rng = random.Random(1)
    for _ in range(150):
        texts = ["".join(rng.choices("ab \n\t▁éЖ漢\U0001f600thein", k=rng.randint(0, 14))) for _ in range(4)]
        for ids, text in zip(sample_ids(vocabulary, texts, keys(4)), texts):
            assert vocabulary.decode(ids) == text.encode()


def test_distribution_against_all_segmentations(vocabulary):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=FILE)
    known = {processor.id_to_piece(int(i)): n for n, i in enumerate(vocabulary.ids)}

    def ways(text):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            if text[:k] in known:
                for rest in ways(text[k:]):
                    yield [known[text[:k]], *rest]

    found = list(ways(chr(MARK) + "then"))
    weights = np.array([math.exp(vocabulary.scores[vocabulary.ids[w]].sum()) for w in found])
    n = 20_000
    drawn = collections.Counter(tuple(x.tolist()) for x in sample_ids(vocabulary, ["then"] * n, keys(n)))
    for way, share in zip(found, weights / weights.sum()):
        ids = tuple(vocabulary.ids[way].tolist())
        assert abs(drawn[ids] / n - share) < 4 * math.sqrt(share / n) + 1e-3
    assert set(drawn) <= {tuple(vocabulary.ids[w].tolist()) for w in found}


def test_draws_do_not_depend_on_batches(vocabulary, monkeypatch):
    texts = [prose(i, 40) + "\n" + prose(i + 50, 40) for i in range(12)]
    whole = sample_ids(vocabulary, texts, keys(12))
    one = [sample_ids(vocabulary, [t], keys(12)[i : i + 1])[0] for i, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "STRETCH", 60)
    cut = sample_ids(vocabulary, texts, keys(12))
    for a, b, c in zip(whole, one, cut):
        assert a.tolist() == b.tolist() == c.tolist()
    other = sample_ids(vocabulary, texts, keys(24)[12:])
    assert any(a.tolist() != b.tolist() for a, b in zip(whole, other))


def test_round_trip_of_awkward_rows(spark, awkward, empty):
    df, rows = awkward
    coded = sample_pieces(df, FILE)
    got = decode_pieces(coded, FILE).collect()
    assert all(r.lossless for r in got)
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(r[0]), r[1] or "") for r in rows)
    again = sample_pieces(df.repartition(5), FILE, with_ids=False).collect()
    assert sorted((str(r.doc_id), r.ids_crc32) for r in again) == sorted((str(r.doc_id), r.ids_crc32) for r in got)
    assert sample_pieces(empty, FILE).collect() == []
