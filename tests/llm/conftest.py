import random

import pytest

CLASHING = ["row", "n_words", "kept", "h", "score", "spans", "c", "n", "_text", "others", "line"]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    schema = DOCUMENTS + "".join(f", {c} string" for c in CLASHING)
    full = [tuple(r) + (None,) * (5 - len(r)) + ("x",) * len(CLASHING) for r in rows]
    return spark.createDataFrame(full, schema)


def prose(seed, n, words=400):
    """Reproducible text of ``n`` words."""
    rng = random.Random(seed)
    vocabulary = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated ids and rows."""
    long = prose(1, 60_000)
    same = prose(2, 120)
    rows = [
        (1, prose(3, 90) + "\n" + prose(4, 60), "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", "en", None, 0),
        (4, " \t\n\r ", None, "a", 5),
        (5, long, "en", "b", len(long)),
        (6, same, "en", "b", 1),
        (6, same, "en", "b", 1),
        (6, prose(5, 80), "fr", "b", 1),
        (None, same, "fr", "b", 1),
        (None, None, None, None, None),
        (7, "▁ un▁marked  été \U0001f600\n\n<|endoftext|> it's", "fr", "a", 9),
        (8, "7" * 5000 + "@" * 50 + "." * 500, "fr", "a", 9),
    ]
    return frame(spark, rows), rows


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
