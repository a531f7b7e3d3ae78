import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from squadbook.llm import tokens
from squadbook.llm.arrays import text_bytes
from squadbook.llm.tokens import EliasFano, Encoder, Memo, read_token_index, write_token_ids
from squadbook.runtime import scratch_path
from tests.llm.conftest import frame, prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def index(spark, df):
    path = scratch_path(spark, "tokens")
    return read_token_index(spark, path, write_token_ids(df, path, FILE)).collect()


def expected(tokenizer, rows):
    out, start = [], 0
    for key, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 700, 9000):
        for top in (1, 2, 40, 5000):
            values = np.cumsum(rng.integers(0, top, n))
            e = EliasFano.encode(values)
            e = EliasFano(n, e.low_bits, e.low.tobytes(), e.high.tobytes(), e.ranks.tobytes())
            assert (e.select(np.arange(n)) == values).all()
            starts, ends = e.span(np.arange(n))
            assert starts[0] == 0 and (starts[1:] == values[:-1]).all() and (ends == values).all()
    spread = EliasFano.encode(np.arange(1, 10_001) * 400)
    assert 8 * (spread.low.nbytes + spread.high.nbytes + spread.ranks.nbytes) < 14 * 10_000


@pytest.mark.parametrize("entries", [20, 100_000])
def test_pieces_give_the_ids_of_whole_texts(tokenizer, entries):
    with open(FILE, encoding="utf-8") as file:
        encoder = Encoder(file.read(), "<u2")
    encoder.memo = Memo(entries, "<u2")
    assert encoder.by_piece
    rng = random.Random(1)
    parts = ["a", "be", "' ", "'s", " ", "\n", ".", "é", "1", " word", "×", "İ", "<|endoftext|>", "\t", "  ", "!?", "漢"]
    for _ in range(300):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4)] + [prose(rng.random(), 9)]
        for text, ids in zip(texts, encoder.encode(*text_bytes(pa.array(texts)))):
            assert tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), text


def test_round_trip(spark, tokenizer, monkeypatch):
    rows = [(i * 3, prose(i, 30 + i) if i % 7 else None) for i in range(90)]
    df = frame(spark, rows).repartition(3)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in index(spark, df))
    assert got == expected(tokenizer, rows)


def test_awkward_rows(spark, tokenizer, awkward, empty):
    df, rows = awkward
    got = sorted(index(spark, df), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda k: -1 if k is None else k)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(k), n, c) for k, _, n, c in expected(tokenizer, [r[:2] for r in rows])
    )
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert index(spark, empty) == []
    assert tokens.SHARD_BYTES > 0
