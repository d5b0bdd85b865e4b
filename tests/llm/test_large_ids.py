"""Ids above 2**53 beside a null, in one partition: every operator hands them on as they are."""

import pytest

from ledgerloom.llm import chat, ngram_join, packing, quality_rules, substring_dedup, token_records
from ledgerloom.llm.encoding import tokenizer_path
from ledgerloom.llm.storage import new_folder

LARGE = [2**53 + 1, 2**53 + 3, 2**63 - 1, None]
BYTES = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def docs(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(LARGE[0], passage), (LARGE[1], f"new start {passage}"), (LARGE[2], "some other text"), (LARGE[3], None)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def ids(df, name="doc_id"):
    return {r[name] for r in df.collect()}


def test_substring_dedup(docs):
    removed = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    assert removed == {LARGE[0]: 0, LARGE[1]: 40, LARGE[2]: 0, None: 0}


def test_ngram_join(spark):
    words = [f"n{i}" for i in range(101)]
    near = " ".join(words[:-1] + ["other"])
    rows = [(LARGE[0], " ".join(words)), (LARGE[1], near), (LARGE[2], "some other text here"), (None, "x")]
    found = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), words=3, percent=90).collect()}
    assert found == {LARGE[0]: (LARGE[0], 1), LARGE[1]: (LARGE[0], 1), LARGE[2]: (LARGE[2], 0), None: (None, 0)}


def test_tokens(spark, docs):
    assert ids(packing.pack(docs, tokenizer_path(BYTES), size=8)) == set(LARGE)
    folder = new_folder(spark, "records")
    token_records.write_records(docs, folder, tokenizer_path(BYTES), 0)
    assert [r.doc_id for r in token_records.read_index(spark, folder).orderBy("start").collect()] == [None, *LARGE[:3]]


def test_chat(spark):
    rows = [(i, 1, "user\x00\x01", "hello") for i in LARGE] + [(LARGE[0], 2, "assistant", "a\x00b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    result = chat.read_back(chat.format_conversations(turns, tokenizer_path(BYTES))).collect()
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in result} == {LARGE[0]: (2, 3), LARGE[1]: (1, 0), LARGE[2]: (1, 0), None: (1, 0)}


def test_quality(docs):
    assert {r.row.doc_id for r in quality_rules.cascade(docs).collect()} == set(LARGE)

