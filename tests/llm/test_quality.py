import re
from collections import Counter

from squadbook.llm.quality import quality_rules
from tests.llm.conftest import frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    starts = range(len(words) - 7)
    counts = Counter(tuple(words[i : i + 8]) for i in starts)
    covered = {i + k for i in starts if counts[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def result(df):
    return {
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in df.collect()
    }


def test_measures(spark, awkward):
    df, rows = awkward
    more = [
        (20, (prose(1, 12) + " ") * 9),
        (21, "a b c d e f g h " * 2 + prose(2, 50)),
        (22, "a a a a a a a a a a " + prose(3, 40)),
        (23, "x y\nx y\n\n \nx y\n#*$%&|<>"),
    ]
    got = quality_rules(df.unionByName(frame(spark, more)))
    assert got.count() == len(rows) + len(more)
    assert result(got) == {(r[0], *measures(r[1])) for r in rows + more}


def test_frequent_lines_of_a_host(spark):
    notice = "Please accept the cookies of this site, all of them, now and for ever and a day and a week"
    rows = [(i, prose(i, 100) + "\n" + notice.upper() + "!", "en", "a") for i in range(30)]
    rows += [(100, notice, "en", "a"), (101, notice + "\nand more", "en", "b")]
    rows += [(200 + i, prose(200 + i, 100), "en", "b") for i in range(30)]
    got = {r.doc_id: r for r in quality_rules(frame(spark, rows)).collect()}
    assert all(got[i].kept and got[i].n_removed_lines == 1 for i in range(30))
    # The notice alone is nothing; on the other host it is a line like any.
    assert not got[100].kept and not got[100].base_failed
    assert got[101].kept


def test_lines_of_a_large_host_go_by_their_number(spark):
    notice = " ".join(f"notice{k}" for k in range(30))
    rows = [(i, prose(i, 25) + "\n" + notice, "en", "hot") for i in range(40)]
    rows += [(100 + i, prose(100 + i, 60), "en", "hot") for i in range(1000)]
    few = {r.doc_id: r for r in quality_rules(frame(spark, rows)).collect()}
    # Less than five in a hundred hold it, and no thousand.
    assert all(few[i].kept and few[i].n_removed_lines == 0 for i in range(40))
    many = {r.doc_id: r for r in quality_rules(frame(spark, rows), max_line_documents=40).collect()}
    # Without the notice less than half of the words are left: depletion decides.
    assert all(not many[i].kept and not many[i].base_failed and many[i].n_removed_lines == 1 for i in range(40))
    assert all(many[100 + i].kept for i in range(1000))


def test_empty_table(empty):
    assert quality_rules(empty).collect() == []
