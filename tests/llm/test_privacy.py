import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest

from squadbook.llm.privacy import (
    KINDS,
    Finder,
    Span,
    find_personal_data,
    labelled_spans,
    rewritten,
    rule_spans,
    training_windows,
)
from squadbook.llm.tagger import Tagger
from tests.llm.conftest import frame, prose

SF = "/root/testdata/sf0.1"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append(Span(kind, *m.span()))
    return out


def card(rng):
    digits = "".join(str(rng.randint(0, 9)) for _ in range(15))
    return next(digits + str(k) for k in range(10) if luhn(digits + str(k)))


def value(kind, rng):
    n = lambda k: "".join(str(rng.randint(0, 9)) for _ in range(k))
    return {
        "email": f"{prose(rng.random(), 1)}.{n(2)}@mail{n(1)}.example.com",
        "ip": ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        "card": card(rng),
        "phone": f"+1 ({n(3)}) {n(3)}-{n(4)}",
    }[kind]


def texts(seed, n):
    rng = random.Random(seed)
    return [" ".join([prose(rng.random(), 12), value(KINDS[i % 4], rng), prose(rng.random(), 9)]) for i in range(n)]


def test_rules_against_patterns():
    rng = random.Random(3)
    for alphabet in ("ab.@-+1 ", "0123 -.", "+1 ().-2", "1.2@a25"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 26)))
            assert plain(text) == rule_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("7" * 300_000, "a" * 300_000 + "@", "+1" + " " * 300_000, "a@" * 200_000):
        assert rule_spans(text) == []
    assert len(rule_spans("1." * 200_000)) == 50_000


def test_awkward_rows(spark, awkward, empty):
    df, rows = awkward
    got = find_personal_data(df).collect()
    digest = lambda spans: hashlib.sha256(",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans).encode()).hexdigest()
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == sorted(
        (str(r[0]), digest(plain(r[1]))) for r in rows
    )
    assert find_personal_data(empty).collect() == []


def test_rules_stand_and_counts(spark):
    rows = list(enumerate(texts(1, 80)))
    for r in find_personal_data(frame(spark, rows)).collect():
        spans = plain(rows[r.doc_id][1])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.kind == k for s in spans) for k in KINDS]
        assert {f"{s.kind}:{s.start}:{s.end}" for s in spans} <= set(r.spans.split(","))


def test_gradients():
    tagger = Tagger(1, hidden=3)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 99, (6, 4)), np.array([[0, 0, 1, 0], [1, 0, 2, 0], [2, 1, 0, 0], [0, 2, 0, 1], [0, 2, 1, 2], [0, 0, 2, 0]])
    _, grads = tagger._loss(x, y)
    for name in ("hf", "hb", "out", "step", "cf"):
        flat, grad = tagger.p[name].reshape(-1), grads[name].reshape(-1)
        for at in (0, len(flat) // 2, len(flat) - 1):
            before = flat[at]
            flat[at] = before + 1e-3
            up = tagger._loss(x, y)[0]
            flat[at] = before - 1e-3
            down = tagger._loss(x, y)[0]
            flat[at] = before
            assert abs((up - down) / 2e-3 - grad[at]) < 2e-2 * max(1, abs(grad[at])), name


def test_tagger_finds_what_rules_do_not():
    """Held out: rewritten values that no rule matches, and texts without any."""
    tagger = Tagger(len(KINDS))
    losses = tagger.train(*training_windows(texts(5, 500), 900))
    assert np.mean(losses[-10:]) < 0.1 * losses[0]
    finder, rng, draw = Finder(tagger, 0.5), random.Random(8), np.random.default_rng(8)
    body, spans = [], []
    while len(body) < 80:
        kind = KINDS[len(body) % 4]
        changed = rewritten(value(kind, rng), kind, draw)
        left = prose(rng.random(), 10) + " "
        text = left + changed + " " + prose(rng.random(), 30)
        if not rule_spans(text):
            body.append(text)
            spans.append(Span(kind, len(left), len(left) + len(changed)))
        elif kind in ("card", "phone") and rng.random() < 0.3:
            body.append(prose(rng.random(), 40))
            spans.append(None)
    found = finder.added(body, [[] for _ in body])
    wanted = [(s, f) for s, f in zip(spans, found) if s]
    assert np.mean([any(x.kind == s.kind and x.start < s.end and x.end > s.start for x in f) for s, f in wanted]) > 0.6
    clean = [prose(1000 + i, 200).replace("w", "") for i in range(30)]
    assert sum(map(len, finder.added(clean, [[] for _ in clean]))) <= 3


def test_labels_of_secrets():
    text = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" api_key: Ab3_Ab3_Ab3_Ab3_Ab3 password = aaaaaaaaaaaaaaaaaaaa'
    labelled = [text[s.start : s.end] for s in labelled_spans(text) if s.kind == "secret"]
    assert labelled == ["04dbebab91ab85687d33eeaaf9ac699e1188f962", "Ab3_Ab3_Ab3_Ab3_Ab3"]
    rng = np.random.default_rng(1)
    values = [rewritten(labelled[0], "secret", rng) for _ in range(50)]
    assert all(20 <= len(v) <= 44 and v.isascii() for v in values) and len(set(values)) == 50


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_secrets_of_a_table(spark):
    """Quoted hex strings, held against a pattern that is no part of the operator."""
    found = wanted = right = 0
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for r in find_personal_data(documents, keep=("doc_id", "text")).collect():
        there = {f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer('"([0-9A-Fa-f]{30,})"', r.text or "")}
        spans = {s for s in r.spans.split(",") if s.startswith("secret")}
        found, wanted, right = found + len(spans), wanted + len(there), right + len(spans & there)
        assert r.n_spans == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
    assert wanted > 100 and right >= 0.9 * wanted and right >= 0.9 * found
