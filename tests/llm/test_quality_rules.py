"""The cascade against rules written out plainly; its order against a small example."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    n, chars = len(words), sum(map(len, words))
    symbols, capitals = len(re.findall(r"[#*$%&|<>]", text)), len(re.findall("[A-Z]", text))
    dup = len(lines) - len(set(lines))
    letterless = sum(not re.search(r"[A-Za-z]|[^\x00-\x7f]", w) for w in words)
    base = n < 10 or 100 * len(covered) > 20 * n
    bad = 100 * symbols > 5 * chars or 100 * capitals > 30 * chars or 100 * dup > 50 * len(lines) or chars < 2 * n or chars > 15 * n or 100 * letterless > 40 * n
    return n, chars, symbols, dup, len(covered), base, not base and not bad


TEXTS = [
    None, "", " \n\t\r\x0b\x0c", "one two three", "a b c d e f g h i j", "the quick brown fox jumps over the lazy dog again today",
    "SHOUTING WORDS ARE HERE AND THERE AND WHERE ARE THEY NOW", "x | y | z | w | a | b | c | d | e | f | g", "αβγ δεζ ηθι κλμ νξο πρσ τυφ χψω äöü ßéñ " * 3,
    "same line here\n" * 8 + "other line there with words enough", "same line here\nsame line here \nsame  line here\n1 2 3 4 5", "cost 12 $ 34 % 56 & 78 <b> *bold* #tag word word",
    "a b c d e a b c d e f", "a a a a a a", "a a a a a", "\x00 nul\x00in side\x1cword \x85next nbsp\xa0same line sep rest of it all", "日本語のとても長い文章" * 5, "w " * 30_000,
]


def judge(docs, **more):
    rows = q.cascade(docs, measures=(*q.MEASURES, "base_failed"), **more).select("row.doc_id", "quality.*").collect()
    return Counter((r.doc_id, *[r[m] for m in q.MEASURES], r.base_failed, r.kept) for r in rows)


def test_cascade_equals_the_plain_rules(make_docs, hard_rows):
    rows = [*[(k, t) for k, t in enumerate(TEXTS)], *hard_rows, (2**53 + 1, "x"), (2**53 + 3, None)]
    expected = Counter((r[0], *plain(r[1])) for r in rows)
    assert judge(make_docs(rows)) == expected
    assert judge(make_docs(rows), sample=1) == expected
    assert {k[-1] for k in expected} == {True, False} == {k[-2] for k in expected}


def test_rejecting_rule_is_named_and_the_rest_stays(make_docs):
    docs = make_docs(list(enumerate(TEXTS)))
    rows = q.cascade(docs).collect()
    assert all(r.quality.kept == (r.quality.rejected_by is None) and r.quality.base_failed is None for r in rows)
    assert {r.quality.rejected_by for r in rows} <= {None, *[r.name for r in q.RULES]}
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [k for k, t in enumerate(TEXTS) if plain(t)[-1]]


def test_empty_table(empty_docs):
    assert q.cascade(empty_docs, measures=q.MEASURES).count() == 0 == q.keep_good(empty_docs).count()


def test_order_is_by_rejections_per_cost_among_what_is_left():
    masks = [0b001] * 6 + [0b011] * 2 + [0b100] * 3 + [0b010] + [0] * 4
    assert q.ordered(masks, [1.0, 1.0, 1.0]) == [0, 2, 1]  # the second rule's rejections are mostly the first one's
    assert q.ordered(masks, [100.0, 1.0, 1.0]) == [1, 2, 0]
    assert q.ordered([], [3.0, 1.0, 2.0]) == [1, 2, 0]
    assert q.ordered([0, 0], [1.0, 1.0]) == [0, 1]


def test_the_cheap_one_of_equal_rules_comes_first(spark):
    import time

    docs = spark.createDataFrame([(k, "few words" if k % 2 else "many words " * 10) for k in range(200)], "doc_id long, text string")
    slow = q.Rule("slow", lambda t: time.sleep(0.002) or t.n_words < 10)
    cheap = q.Rule("cheap", lambda t: t.n_words < 10)
    rows = q.cascade(docs, (slow, cheap), base=()).collect()
    assert [r.quality.rejected_by for r in rows] == ["cheap" if r.row.doc_id % 2 else None for r in rows]


@pytest.mark.parametrize("text, words", [("a b c d e a b c d e", 10), ("a b c d e f", 0), ("a a a a a a", 6), ("a b c d e x a b c d e y b c d e x", 16)])
def test_repeated_windows(text, words):
    assert q.Text(text.encode()).n_repeat_words == words == plain(text)[4]


def test_numbers_are_null_safe(spark):
    docs = spark.createDataFrame([(None, "x " * 20), (None, None)], "doc_id long, text string")
    assert q.cascade(docs, measures=("n_words",)).agg(F.sum("quality.n_words")).first()[0] == 20
