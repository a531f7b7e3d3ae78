import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from squadbook.operators import (
    EmptyResultError,
    build_alias_dim,
    count_mentions,
    match_mentions,
    mention_summary,
    prepare_aliases,
    top_mention,
)
from squadbook.operators import mentions
from squadbook.operators.mentions import BROADCAST_BYTES

ROSTER = [
    ("L. Messi", "Lionel Andrés Messi"),
    ("Neymar Jr.", "Neymar da Silva"),
    ("Mbappé", None),
    ("  ", "Nobody"),
    (None, "Nothing"),
    ("B. Twin", "Shared Name"),
    ("A. Twin", "Shared Name"),
    (" Padded ", "   "),
]

COMMENTS = [
    "L. Messi and Lionel Andrés Messi",
    "l. messi, L. MESSI!",
    "xl. messi",
    "MBAPPÉ",
    "mbappés",
    "neymar jr. is",
    "neymar jr.x",
    "shared name",
    "padded",
    "",
    None,
]


@pytest.fixture
def shuffled_joins(spark):
    """No join is broadcast unless it is hinted."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def aliases(spark):
    return build_alias_dim(spark.createDataFrame(ROSTER, "short_name string, long_name string"))


@pytest.fixture
def comments(spark):
    return spark.createDataFrame(list(enumerate(COMMENTS)), "comment_id int, text string")


def counts(df):
    return {r["canonical"]: r["mentions"] for r in df.collect()}


def test_build_alias_dim(aliases):
    assert {tuple(r) for r in aliases.collect()} == {
        ("l. messi", "L. Messi"),
        ("lionel andrés messi", "L. Messi"),
        ("neymar jr.", "Neymar Jr."),
        ("neymar da silva", "Neymar Jr."),
        ("mbappé", "Mbappé"),
        ("b. twin", "B. Twin"),
        ("a. twin", "A. Twin"),
        ("shared name", "A. Twin"),
        ("padded", "Padded"),
    }


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_count_mentions(comments, aliases, limit):
    got = counts(count_mentions(comments, aliases, broadcast_bytes=limit))
    assert got == {"L. Messi": 3, "Mbappé": 1, "Neymar Jr.": 1, "A. Twin": 1, "Padded": 1}


def expected_matches(texts, names, boundary="word"):
    """Every name tried on every text with Python's own word boundaries, or look-arounds."""
    found = set()
    for alias, canonical in names.items():
        edges = (r"\b", r"\b") if boundary == "word" else (r"(?<!\w)", r"(?!\w)")
        pattern = re.compile(edges[0] + re.escape(alias) + edges[1])
        for key, text in texts:
            if pattern.search(text.lower()):
                found.add((key, alias, canonical))
    return found


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("boundary", ["word", "loose"])
def test_matches_equal_brute_force(spark, seed, limit, boundary, monkeypatch):
    # Runs so short that many aliases are longer.
    monkeypatch.setattr(mentions, "MAX_RUN", 2 if seed == 2 else 8)
    rng = random.Random(seed)
    letters = ["a", "b", "É", "_", "1", ".", " ", "-", "\n", "'", "½", "́"]
    texts = [(i, "".join(rng.choices(letters, k=rng.randrange(0, 30)))) for i in range(200)]
    names = {"".join(rng.choices(letters, k=rng.randrange(1, 6))).lower() for _ in range(150)}
    names = {alias: f"N{i % 20}" for i, alias in enumerate(sorted(names))}
    comments = spark.createDataFrame(texts, "comment_id int, text string")
    aliases = spark.createDataFrame(list(names.items()), "alias string, canonical string")

    wanted = expected_matches(texts, names, boundary)
    assert len(wanted) > 100
    aliases = prepare_aliases(aliases, boundary)
    found = match_mentions(comments, aliases, broadcast_bytes=limit)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == wanted
    totals = count_mentions(comments, aliases, broadcast_bytes=limit)
    assert counts(totals) == Counter(canonical for _, _, canonical in wanted)


def test_long_aliases_are_found_whole(spark):
    words = [f"w{i}" for i in range(40)]
    comments = spark.createDataFrame([(1, "x " + ", ".join(words) + " y"), (2, ", ".join(words[:-1]))], "comment_id int, text string")
    aliases = spark.createDataFrame([(", ".join(words), "All"), ("w1", "One")], "alias string, canonical string")
    assert counts(count_mentions(comments, aliases)) == {"All": 1, "One": 2}


def test_an_alias_of_thousands_of_words(spark):
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(["x", *words, "y"]), " ".join(words[:-1]), " ".join(words[:-1]) + " w1999s", " ".join(words)]
    comments = spark.createDataFrame(list(enumerate(texts)), "comment_id int, text string")
    aliases = spark.createDataFrame([(" ".join(words), "All"), ("w7", "One")], "alias string, canonical string")
    for limit in (BROADCAST_BYTES, 0):
        assert counts(count_mentions(comments, aliases, broadcast_bytes=limit)) == {"All": 2, "One": 4}


def test_long_aliases_that_begin_alike_have_anchors_of_their_own(spark):
    begin = " ".join(f"b{i}" for i in range(20))
    names = [f"{begin} own{k} {begin}" for k in range(50)]
    texts = [f"x {names[3]}, y", begin, f"{begin} own7 b0", f"{names[4]} {names[4]}"]
    comments = spark.createDataFrame(list(enumerate(texts)), "comment_id int, text string")
    aliases = spark.createDataFrame([(n, f"N{k}") for k, n in enumerate(names)], "alias string, canonical string")
    table = prepare_aliases(aliases)
    assert table.names.select("__run").distinct().count() == 50
    for limit in (BROADCAST_BYTES, 0):
        assert counts(count_mentions(comments, table, broadcast_bytes=limit)) == {"N3": 1, "N4": 1}
    assert mentions.all_mentions(comments, table).count() == 3
    # Words that are frequent in texts are avoided as well.
    rare = spark.createDataFrame([("a b c d e f g h", "X")], "alias string, canonical string")
    sample = spark.createDataFrame([("a b c d e f h " * 50,)], "text string")
    assert prepare_aliases(rare, texts=sample).names.first()["at"] == 6


def test_loose_boundary(spark):
    texts = ["neymar jr. is great", "neymar jr.x", "xneymar jr.", "(neymar jr.)", "neymar jr..", "neymar jr"]
    comments = spark.createDataFrame(list(enumerate(texts)), "comment_id int, text string")
    aliases = spark.createDataFrame([("neymar jr.", "N")], "alias string, canonical string")
    for limit in (BROADCAST_BYTES, 0):
        assert counts(count_mentions(comments, aliases, broadcast_bytes=limit)) == {"N": 1}
        assert counts(count_mentions(comments, aliases, broadcast_bytes=limit, boundary="loose")) == {"N": 3}
    with pytest.raises(ValueError):
        prepare_aliases(aliases, "tight")


def test_every_row_is_a_comment(spark):
    rows = [("", "messi"), ("", "messi and messi"), (None, "Messi!"), ("1", "messi"), ("1", "messi")]
    comments = spark.createDataFrame(rows, "comment_id string, text string")
    aliases = spark.createDataFrame([("messi", "M")], "alias string, canonical string")
    for limit in (BROADCAST_BYTES, 0):
        assert counts(count_mentions(comments, aliases, broadcast_bytes=limit)) == {"M": 5}
        assert counts(count_mentions(comments, aliases, ["comment_id"], broadcast_bytes=limit)) == {"M": 3}
    assert match_mentions(comments, aliases, None).count() == 5


def test_hot_word_and_mixed_case_aliases(spark):
    comments = spark.range(3000).select(
        F.col("id").alias("comment_id"),
        F.when(F.col("id") % 3 == 0, "goal by Messi, messi!").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    aliases = spark.createDataFrame([("MESSI", "B"), ("messi", "A"), ("", "E")], "alias string, canonical string")
    for limit in (BROADCAST_BYTES, 0):
        assert counts(count_mentions(comments, aliases, broadcast_bytes=limit)) == {"A": 1000}


def test_large_alias_tables_meet_the_texts_in_a_shuffle(spark, comments, aliases, shuffled_joins):
    counted = count_mentions(comments, aliases, broadcast_bytes=0)
    matched = match_mentions(comments, aliases, broadcast_bytes=0)
    for df in (counted, matched):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        # The bitmap is a value in the selection that cuts the texts.
        assert "BroadcastExchange" not in plan and plan.count("regexp_extract_all") == 1
    assert counts(counted) == counts(count_mentions(comments, aliases))
    assert sorted(map(tuple, matched.collect())) == sorted(
        map(tuple, match_mentions(comments, aliases).collect())
    )


def test_no_aliases(spark, comments, aliases):
    none = aliases.where(F.lit(False))
    assert prepare_aliases(none).shapes == ()
    assert count_mentions(comments, none).count() == 0
    assert match_mentions(comments, none, broadcast_bytes=0).count() == 0


def test_top_mention_and_summary(spark):
    tied = spark.createDataFrame([("B", 2), ("A", 2), ("C", 1)], "canonical string, mentions long")
    assert tuple(top_mention(tied).first()) == ("A", 2)
    summary = sorted(tuple(r) for r in mention_summary(tied).collect())
    assert summary == [("A", 2, "A", 2), ("A", 2, "B", 2), ("A", 2, "C", 1)]
    nothing = tied.where(F.lit(False))
    assert top_mention(nothing, on_empty="empty").count() == 0
    assert mention_summary(nothing).count() == 0
    with pytest.raises(EmptyResultError):
        top_mention(nothing)
    with pytest.raises(ValueError):
        top_mention(tied, on_empty="skip")


def test_texts_are_not_shuffled(comments, aliases):
    plan = count_mentions(comments, aliases)._jdf.queryExecution().executedPlan().toString()
    cut = plan[: plan.index("regexp_extract_all")]
    assert "BroadcastHashJoin" in cut and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
