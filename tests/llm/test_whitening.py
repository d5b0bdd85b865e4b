"""Whitening against numpy's eigenvalues and exact whole numbers."""

import numpy as np
import pytest

from ledgerloom.llm import whitening
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.symmetric_eigen import below, largest, leading, tridiagonal

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, component string, row string, n string, vector string"


def check(rows, vectors, k=8):
    """``rows`` as returned; ``vectors``: (id, list) of those that take part, in any order."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array(x, float) - np.array(sums) / n
    cov = centred.T @ centred / n
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1], directions[:, ::-1]
    found = {}
    for r in rows:
        found.setdefault(r.component, []).append(r)
    assert sorted(found) == list(range(1, min(k, len(values)) + 1))
    deviation = sorted((i, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for (i, _), v in zip(vectors, x))
    for c, same in found.items():
        assert sorted((r.vec_id, r.deviation) for r in same) == deviation
        assert {r.n for r in same} == {n} and same[0].explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-10)
        white = centred @ directions[:, c - 1] / np.sqrt(values[c - 1])
        ours = np.array([r.whitened for r in sorted(same, key=lambda r: (r.vec_id, r.whitened))])
        signs = []
        for sign in (1, -1):
            plain = np.array([w for _, w in sorted(zip([i for i, _ in vectors], (sign * white).tolist()))])
            signs.append(np.abs(plain - ours).max())
        assert min(signs) < 1e-7
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-4


def flat(df):
    return df.select("row.vec_id", *[c for c in df.columns if c != "row"]).collect()


def test_query(spark):
    result = QUERIES["op13_embedding_whitening"](spark, FOLDER)
    assert result.columns == "vec_id component n deviation whitened explained identity_error".split()
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(result.collect(), vectors)


def test_hard_rows(spark):
    draw = np.random.default_rng(4)
    good = [(2**53 + 1 + k, (draw.standard_normal(5) * [5, 4, 3, 2, 1]).tolist()) for k in range(200)]
    good += [good[0], good[0], (7, [0.0] * 5), (7, [-1e3, 2e3, 0.5, 1e-300, -0.0])]
    bad = [(1, None), (2, [1.0, None, 2.0, 3.0, 4.0]), (3, [float("nan")] * 5), (4, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (5, [1.0, 2.0]), (6, []), (8, [2.0**33] * 5)]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in good + bad], SCHEMA).repartition(5)
    whole = whitening.whiten_embeddings(df)
    assert whole.select("row.component", "row.n").distinct().count() == 1
    check(flat(whole), good)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, [])], [(None, [float("nan")])]])
def test_without_variance_there_are_no_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    result = whitening.whiten_embeddings(df)
    assert result.columns == "row component n deviation whitened explained identity_error".split() and result.count() == 0


def test_components_without_variance_are_left_out(spark):
    draw = np.random.default_rng(1)
    plane = [(None, [float(a), float(b), float(a + b), 3.0]) for a, b in draw.integers(-9, 9, (50, 2))]
    rows = flat(whitening.whiten_embeddings(spark.createDataFrame(plane, "vec_id long, embedding array<float>")))
    assert {r.component for r in rows} == {1, 2} and len(rows) == 100 and rows[0].identity_error < 1e-10


def test_deviation_beyond_a_long_is_null(spark):
    rows = flat(whitening.whiten_embeddings(spark.createDataFrame([(1, [4e9, 0.0]), (2, [-4e9, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")))
    assert {(r.vec_id, r.deviation is None) for r in rows} == {(1, True), (2, True), (3, False)}


MATRICES = [
    np.eye(12), np.diag([3.0, 3, 3, 2, 2, 1, 1, 0, 0]), np.ones((9, 9)), np.kron(np.eye(4), [[2.0, 1], [1, 2]]), np.kron(np.ones((3, 3)), np.eye(5)),
    np.diag(10.0 ** -np.arange(16)), np.eye(20) + 1e-12, np.array([[2.0]]), np.array([[2.0, 1], [1, 2]]), 1e150 * np.diag([1.0, 2, 3]), np.zeros((4, 4)),
]


@pytest.mark.parametrize("matrix", MATRICES)
def test_leading_values_and_vectors(matrix):
    values, vectors = leading(matrix, 8)
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][: len(values)]).max() <= 1e-13 * scale * len(matrix)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale * len(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


@pytest.mark.parametrize("n", [3, 17, 64, 120])
def test_random_matrices(n):
    a = np.random.default_rng(n).standard_normal((n, 2 * n))
    matrix = a @ a.T
    values, vectors = leading(matrix, 8)
    assert np.abs(values / np.linalg.eigvalsh(matrix)[::-1][: len(values)] - 1).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * values[0]
    diagonal, off, _ = tridiagonal(matrix)
    assert below(diagonal, off, np.array([-1.0, 2 * values[0]]), 1e-300).tolist() == [0, n]
    assert largest(diagonal, off, 1)[0] == pytest.approx(values[0], rel=1e-14)
