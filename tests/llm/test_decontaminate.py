import duckdb
import pytest

from squadbook.llm.decontaminate import contaminated, decontaminate
from squadbook.llm.queries import ORACLES, op6_decontamination
from tests.llm.conftest import frame, prose

ITEM = "Tom has 3 apples and Tom buys 5 more apples, so how many apples does Tom have now in the red basket?"


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.fixture(params=[10**6, 0], ids=["broadcast", "shuffled"])
def bound(request):
    return request.param


def found(docs, items, **options):
    return {(r.doc_id, r.item_id) for r in contaminated(docs, items, **options).collect()}


def test_exact_and_re_parameterised(spark, bound):
    items = benchmark(spark, [(1, ITEM), (2, prose(1, 30)), (3, "too short"), (4, None), (5, "")])
    other = ITEM.replace("Tom", "Ann").replace("3", "14").replace("5", "2")
    docs = frame(
        spark,
        [
            (1, "Before. " + ITEM + " After."),
            (2, prose(8, 50) + " " + other),
            (3, other.replace("does Ann", "does Bob")),
            (4, prose(1, 30).upper()),
            (5, prose(9, 300)),
            (6, None),
            (7, ""),
            (8, " ".join(prose(1, 30).split(" ")[:10])),
            (None, prose(1, 30)),
        ],
    )
    got = found(docs, items, broadcast_windows=bound)
    # Row 3 gives two values to one name, row 8 holds a part of an item only.
    assert got == {(1, 1), (2, 1), (4, 2), (None, 2)}


def test_slots_must_be_one_to_one(spark):
    item = "a box holds 7 red balls and 7 blue balls and 9 green balls in all there are"
    items = benchmark(spark, [(1, item)])
    docs = frame(
        spark,
        [
            (1, item.replace("7", "4").replace("9", "6")),
            (2, item.replace("7 red", "4 red").replace("7 blue", "5 blue")),
            (3, item.replace("7", "4").replace("9", "4")),
        ],
    )
    assert found(docs, items) == {(1, 1)}


def test_units_and_numbers_are_typed(spark):
    items = benchmark(spark, [(1, "the road is 12 km long and a car drives it at 90 km every single hour")])
    docs = frame(
        spark,
        [
            (1, "the road is 15 miles long and a car drives it at 60 miles every single hour"),
            (2, "the road is very badly long and a car drives it at full speed every single hour"),
        ],
    )
    assert found(docs, items) == {(1, 1)}


def test_kept_rows(spark, awkward, empty):
    df, rows = awkward
    items = benchmark(spark, [(1, rows[5][1])])
    kept = decontaminate(df, items)
    assert kept.columns == df.columns
    assert kept.count() == len(rows) - 3
    assert decontaminate(empty, items).collect() == []
    assert decontaminate(df, benchmark(spark, [])).count() == len(rows)
    assert decontaminate(df, benchmark(spark, [(1, None)])).count() == len(rows)


@pytest.mark.parametrize("n", [30, 100])
def test_a_word_put_in_or_left_out_in_the_middle(spark, bound, n):
    words = prose(21, n).split(" ")
    item, half = " ".join(words), n // 2
    question = (
        "in the morning our Tom has 3 apples and then Tom buys 5 more apples at the market, "
        "so how many apples does Tom have now in the red basket at home?"
    )
    named = question.replace("Tom", "Ann").replace("3", "14").replace("5", "2")
    items = benchmark(spark, [(1, item), (2, question)])
    docs = frame(
        spark,
        [
            (1, " ".join(words[:half] + ["extra"] + words[half:])),
            (2, " ".join(words[:half] + words[half + 1 :])),
            (3, " ".join(words[: half // 2])),
            (4, named.replace("the market", "the big market")),
            # The two halves give two values to one name.
            (5, named.replace("the market", "the big market").replace("does Ann", "does Bob")),
        ],
    )
    wanted = {(1, 1), (2, 1), (4, 2)}
    assert found(docs, items, broadcast_windows=bound) == wanted


def test_names_that_open_a_sentence(spark, bound):
    question = "Tom has 5 apples. Tom buys 3 more. How many apples does Tom have now?"
    named = question.replace("Tom", "Ann").replace("5", "7").replace("3", "9")
    items = benchmark(spark, [(1, question)])
    docs = frame(
        spark,
        [
            (1, "Well. " + named + " Sure."),
            (2, named.replace("does Ann", "does Bob")),
            (3, named.replace("buys", "sells").replace("many", "few").replace("apples", "pears")),
        ],
    )
    assert found(docs, items, broadcast_windows=bound) == {(1, 1)}


def test_sql_states_the_same_rule(spark, path):
    """On rows that need it: words put in, names that open sentences, fills that disagree."""
    words = prose(21, 30).split(" ")
    question = (
        "Tom is early. In the morning our Tom has 3 apples and then Tom buys 5 more apples at the market, "
        "so how many apples does Tom have now in the red basket at home?"
    )
    named = question.replace("Tom", "Ann").replace("3", "14").replace("5", "2")
    odd = named.replace("the market", "the big market")
    texts = [
        " ".join(words[:15] + ["extra"] + words[15:]),
        " ".join(words[:10] + words[11:20] + ["a", "b"] + words[20:]),
        named,
        odd,
        odd.replace("does Ann", "does Bob"),
        odd + " " + question,
        question.replace("Tom has", "Tom Smith has").replace("5", "5 000"),
        " ".join(words[:12]),
        None,
    ]
    frame(spark, list(enumerate(texts))).write.parquet(f"{path}/documents.parquet")
    items = benchmark(spark, [(1, " ".join(words)), (2, question), (2, question), (3, None)])
    items.write.parquet(f"{path}/benchmark.parquet")
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    wanted = connection.execute(ORACLES["op6_decontamination"])
    columns = [c[0] for c in wanted.description]
    got = sorted(tuple(r[c] for c in columns) for r in op6_decontamination(spark, path).collect())
    assert got == sorted(wanted.fetchall())
    assert {r[0] for r in got} >= {0, 2, 3, 5}
