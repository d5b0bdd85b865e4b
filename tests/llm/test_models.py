"""Toxicity by held-out accuracy, neighbours by recall against brute force, and the pipeline as a whole."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import neighbours, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    hard = spark.createDataFrame([(None, None), (-1, ""), (-2, None), (-2, "you idiot " * 20_000), (-3, "  ß")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(hard)
    return toxicity.score_documents(rows, labels).collect(), labels.collect(), rows.count()


def test_toxicity_on_held_out_labels(scored):
    rows, labels, count = scored
    assert len(rows) == count and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    toxic = {r.doc_id: r.toxic for r in labels}
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and toxic.get(r.doc_id) is not None]
    ones, zeros = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    assert auc >= 0.9
    assert np.mean([s < 0.5 for s in zeros]) >= 0.98


def test_toxicity_of_empty_and_very_long_texts(scored):
    by_id = {}
    for r in scored[0]:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[None][0].score == by_id[-1][0].score < 0.5 and len(by_id[-2]) == 2


def test_features_look_at_the_whole_text():
    late = "word " * 50_000 + "you idiot"
    values = dict(zip(toxicity.FEATURES, toxicity.features(late, {"idiot": 5.0}, {"idiot": 5.0})))
    assert values["word_hits"] > 0 and values["near_second_person"] == 1.0 and values["strongest"] == 5.0
    assert toxicity.features(None, {}, {}) == toxicity.features("", {}, {})
    hidden = dict(zip(toxicity.FEATURES, toxicity.features("1d1ot i-d-i-o-t st@r", {"idiot": 5.0}, {})))
    assert hidden["hidden_hits"] > 0 and hidden["obfuscation"] > 0


def test_toxicity_without_rows_or_with_one_class(spark, make_docs, empty_docs):
    kinds = "doc_id long, toxic int, rank string, features string"
    docs = make_docs([(k, f"some text {k}") for k in range(30)] + [(None, None), (3, "")])
    none, zeros, ones = (spark.createDataFrame([(k, v, "x", "x") for k in range(n)], kinds) for n, v in ((0, 0), (30, 0), (30, 1)))
    for labels, score in ((none, 0.0), (zeros, 0.0), (ones, 1.0)):
        rows = toxicity.score_documents(docs, labels).collect()
        assert len(rows) == 32 and {r.score for r in rows} == {score} and {r.predicted for r in rows} == {int(score)}
    for labels in (none, zeros):
        assert toxicity.score_documents(empty_docs, labels).count() == 0 and toxicity.drop_toxic(empty_docs, labels).count() == 0
        kept = toxicity.drop_toxic(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 32
    nulls = spark.createDataFrame([(1, None, "x", "x"), (None, 1, "x", "x")], kinds)
    assert {r.score for r in toxicity.score_documents(docs, nulls).collect()} == {0.0}


def test_cells_grow_with_the_table_and_the_sample_is_cut_first(spark):
    assert [neighbours.centroids_for(n) for n in (1, 500, 25_000, 10**9)] == [8, 15, 38, 534]
    draw = np.random.default_rng(3)
    df = spark.createDataFrame([(k, draw.normal(size=4).tolist()) for k in range(3000)], "id long, vector array<double>")
    index = neighbours.build_index(df, 10, sample=200)
    assert index.rows.sum() == 3000 and index.rows.shape == (23, 23)
    wide = neighbours.build_index(df, 10, centroids=100, sample=1000)
    seen = {i: np.unpackbits(np.frombuffer(m, np.uint8), bitorder="little")[: wide.rows.shape[1]] for i, m in wide.wanted(np.zeros(4), 0.5).items()}
    assert 1500 <= sum(int((wide.rows[i] * m).sum()) for i, m in seen.items()) <= 1600
    same = spark.createDataFrame([(7, [1.0, 2.0])] * 50, "id long, vector array<double>")
    assert neighbours.build_index(same, 10, sample=1).rows.sum() == 50


def plain_neighbours(rows, queries, k=10):
    good = {}
    for name, v in rows:
        if name is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(name, []).append(np.array(v, float))
    out = {}
    for q in (n for n in good if queries(n)):
        near = sorted((float(np.sqrt(((v - good[q][0]) ** 2).sum())), n) for n, vs in good.items() if n != q for v in vs)
        out[q] = near[:k]
    return out


def test_neighbours(spark):
    draw = random.Random(1)
    centres = [[draw.gauss(0, 3) for _ in range(8)] for _ in range(12)]
    rows = [(i, [draw.gauss(c, 0.5) for c in draw.choice(centres)]) for i in range(2000)]
    rows += [(i, [1.0] * 8) for i in range(2000, 2600)]  # a third of a block is one vector
    rows += [(9000, None), (9100, [0.0] * 8), (9200, [1.0, None] * 4), (9300, [float("nan")] * 8), (9400, [1.0] * 3), (None, [2.0] * 8), (9500, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x"))
    found = {}
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    expected = plain_neighbours(rows, lambda n: n % 100 == 0)
    assert set(found) == set(expected) and all(len(v) == 10 for v in found.values())
    recall = np.mean([len({n for _, n in found[q]} & {n for _, n in expected[q]}) / 10 for q in expected])
    assert recall >= 0.9
    assert found[2000] == [(0.0, n) for n in range(2001, 2011)]
    everything = dict(rows)
    for q, near in found.items():
        assert near == sorted(near)
        for score, n in near:
            assert score == pytest.approx(np.linalg.norm(np.array(everything[q]) - np.array(everything[n])), rel=1e-12)


def test_neighbours_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.rank) for r in neighbours.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert neighbours.search(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_traversal_is_in_order_of_distance():
    draw = np.random.default_rng(0)
    index = neighbours.Index(draw.normal(size=(6, 2)), draw.normal(size=(5, 3)), np.ones((6, 5), np.int64), 1.0)
    vector = draw.normal(size=5)
    total = [((index.first[i] - vector[:2]) ** 2).sum() + ((index.second[j] - vector[2:]) ** 2).sum() for i, j in index.traverse(vector)]
    assert len(total) == 30 and total == sorted(total)


def test_pipeline_stages(spark, make_docs, hard_rows, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.unionByName(make_docs(hard_rows).select(docs.columns))
    texts = [set() for _ in corpus_pipeline.STAGES]
    current, before = docs, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, current, FOLDER)
        target = str(tmp_path / str(k))
        result.write.parquet(target)
        current = spark.read.parquet(target)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert current.columns == docs.columns
        if k < 3:
            rows = current.select("text").collect()
            assert 0 < len(rows) < before
            before, texts[k] = len(rows), [r.text or "" for r in rows]
    assert len(texts[1]) == len(set(texts[1])) and set(texts[1]) == set(texts[0])
    assert current.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
