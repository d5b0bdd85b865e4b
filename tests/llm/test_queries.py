"""The registered corpus queries: against SQL where there is SQL, and their columns."""

import duckdb
import pytest

from ledgerloom.llm.oracle import ORACLE_SQL
from ledgerloom.llm.queries import QUERIES
from tests.compare import differences

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "conversations", "labels", "benchmark")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE_SQL[name]) == []


COLUMNS = {
    "op5_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6_neighbours": "query_id rank vec_id score",
    "op7_shard": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_token_records": "doc_id start n_tokens ids_crc32",
    "op10_pack": "doc_id piece start length ids_crc32 sequence_id offset",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    result = QUERIES[name](spark, FOLDER)
    assert result.columns == COLUMNS[name].split()
    assert result.count() > 0


def test_planted_conversation(spark):
    row = QUERIES["op5_chat_format"](spark, FOLDER).where("conv_id = -7").first()
    assert (row.n_turns, row.loss_chars) == (2, len(r"\### Assistant: </turn> ok"))


def test_recall(spark):
    import numpy as np

    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").where("embedding is not null").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {}
    for r in QUERIES["op6_neighbours"](spark, FOLDER).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in ids[ids % 100 == 0].tolist():
        distance = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        distance[ids == q] = np.inf
        hits.append(len(found[q] & set(ids[np.argsort(distance, kind="stable")[:10]].tolist())) / 10)
    assert np.mean(hits) >= 0.9
